"""Repeatable samples, splits and folds, ordered by a hash of the row's key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.operators.ranks import hash_cuts, hash_key


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows in hash order: a top-n per task, then a merge of n rows each."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(order).limit(n)


def stratified_split(df: DataFrame, label: str, key: str, train_tenths: int = 8) -> DataFrame:
    """Adds ``split``: of each class exactly the given tenths, rounded down, are 'train'.

    One hash per class says where to cut; the rows themselves are not moved.
    """
    n_train = F.floor(F.col("n") * train_tenths / 10)
    cuts = hash_cuts(df.where(F.col(label).isin(0, 1)), label, key, {"cut": n_train - 1})
    cuts = F.broadcast(cuts.drop("n"))  # two rows
    marked = df.join(cuts, label, "left").withColumn("h", hash_key(key))
    train = F.coalesce(F.col("h") <= F.col("cut"), F.lit(False))
    return marked.withColumn("split", F.when(train, "train").otherwise("valid")).drop("h", "cut")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 3) -> DataFrame:
    """Adds ``fold`` 0..k-1, each holding the same share of each class to within one row."""
    ranks = {f"cut_{i}": F.ceil(F.col("n") * (i + 1) / k) - 1 for i in range(k - 1)}
    cuts = hash_cuts(df.where(F.col(label).isin(0, 1)), label, key, ranks).drop("n")
    marked = df.join(F.broadcast(cuts), label, "left").withColumn("h", hash_key(key))  # two rows
    beyond = [F.coalesce(F.col("h") > F.col(c), F.lit(False)).cast("int") for c in ranks]
    fold = sum(beyond[1:], beyond[0])
    return marked.withColumn("fold", fold).drop("h", *ranks)
