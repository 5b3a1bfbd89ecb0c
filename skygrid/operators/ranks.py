"""Exact ranks without a single-task sort.

Everything that needs an order over a whole column (quantiles, AUC, splits) starts from the table
of distinct values with their counts, so a value that fills a third of the rows is one row. Those
distinct values are range-partitioned and written with the number of their range. Sums per range
give each range's offset, and only the inside of a range is ever sorted by one task. There are as
many ranges as shuffle partitions; written ranges stay the same when a task runs again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skygrid.session import scratch_path

def value_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, x, c): distinct non-null values of each feature with their counts.

    Rows are counted under the feature's number, which hashes faster than its name.
    """
    pairs = [F.struct(F.lit(i).alias("f"), F.col(f).cast("double").alias("x")) for i, f in enumerate(features)]
    long = df.select(*by, F.inline(F.array(*pairs))).where(F.col("x").isNotNull())
    counted = long.groupBy(*by, "f", "x").agg(F.count("*").alias("c"))
    names = F.array(*[F.lit(f) for f in features])
    return counted.select(*by, F.get(names, F.col("f")).alias("feature"), "x", "c")


def bucketed(values: DataFrame, by: Sequence[str], weights: Sequence[str], x: str = "x"):
    """Split distinct values into ordered ranges.

    Returns ``(rows, totals)``: the rows with ``bucket``, and one row per (by, bucket) holding for
    each weight ``w`` its sum ``w_in``, the sum in earlier buckets ``w_off`` and over all ``w_all``.
    ``by`` must name few groups, fixed while planning (features, two classes, models): one row per
    group and writing task is broadcast.
    """
    by = list(by)
    path = scratch_path(values.sparkSession, "ranges")
    ranged = values.repartitionByRange(*by, x).withColumn("bucket", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = values.sparkSession.read.schema(ranged.schema).parquet(path)
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    totals = (
        rows.groupBy(*by, "bucket")
        .agg(*[F.sum(w).alias(f"{w}_in") for w in weights])
        .withColumns({f"{w}_off": F.coalesce(F.sum(f"{w}_in").over(before), F.lit(0)) for w in weights})
        .withColumns({f"{w}_all": F.sum(f"{w}_in").over(whole) for w in weights})
    )
    return rows, totals


def running_before(
    values: DataFrame, weights: Sequence[str], by: Sequence[str] = (), x: str = "x"
) -> DataFrame:
    """Adds ``w_before`` (sum of w over smaller x) and ``w_all`` to every distinct value."""
    by = list(by)
    rows, totals = bucketed(values, by, weights, x)
    inside = Window.partitionBy(*by, "bucket").orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(totals.drop(*[f"{w}_in" for w in weights])), [*by, "bucket"])
    return rows.withColumns(
        {f"{w}_before": F.col(f"{w}_off") + F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights}
    ).drop("bucket", *[f"{w}_off" for w in weights])


def quantiles(
    values: DataFrame, probs: dict[str, float], by: Sequence[str] = ("feature",)
) -> DataFrame:
    """Exact quantiles, linear between neighbours, from ``value_counts`` rows.

    ``probs`` maps output names to probabilities. One row per group: by..., n, and each name.
    """
    by = list(by)
    rows, totals = bucketed(values, by, ["c"])
    position = {name: F.lit(p) * (F.col("c_all") - 1) for name, p in probs.items()}
    wanted = F.array_distinct(
        F.flatten(F.array(*[F.array(F.floor(q), F.ceil(q)) for q in position.values()]))
    )
    here = F.filter(
        wanted, lambda k: (k >= F.col("c_off")) & (k < F.col("c_off") + F.col("c_in"))
    )
    hit = totals.withColumn("ks", here).where(F.size("ks") > 0)
    hit = hit.select(*by, "bucket", "c_off", "c_all", "ks")
    inside = Window.partitionBy(*by, "bucket").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("c_off") + F.coalesce(F.sum("c").over(inside), F.lit(0))
    picked = (
        rows.join(F.broadcast(hit), [*by, "bucket"])
        .withColumn("start", start)
        .withColumn("ks", F.filter("ks", lambda k: (k >= F.col("start")) & (k < F.col("start") + F.col("c"))))
        .where(F.size("ks") > 0)
    )
    low = {n: F.max(F.when(F.array_contains("ks", F.floor(q)), F.col("x"))) for n, q in position.items()}
    high = {n: F.max(F.when(F.array_contains("ks", F.ceil(q)), F.col("x"))) for n, q in position.items()}
    # After grouping, c_all is one value per group.
    return (
        picked.groupBy(*by, "c_all")
        .agg(
            *[low[n].alias(f"{n}_lo") for n in probs],
            *[high[n].alias(f"{n}_hi") for n in probs],
        )
        .select(
            *by,
            F.col("c_all").alias("n"),
            *[
                (
                    F.col(f"{n}_lo")
                    + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * (q - F.floor(q))
                ).alias(n)
                for n, q in position.items()
            ],
        )
    )


def hash_key(c: Column | str) -> Column:
    """Even, repeatable order for sampling and splitting; the same text in any engine."""
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(c.cast("string"))


def hash_cuts(df: DataFrame, label: str, key: str, ranks: dict[str, Column]) -> DataFrame:
    """Per class, the hash of the row at given 0-based ranks in hash order.

    ``ranks`` are expressions over ``n``, the class size. Hashes are uniform, so their first four
    characters cut a class into 65,536 even buckets; only the buckets holding a wanted rank are
    sorted, each a 65,536th of its class. One row per class: label, n, one column per rank.
    """
    rows = df.select(F.col(label).alias("y"), hash_key(key).alias("h"))
    rows = rows.withColumn("bucket", F.substring("h", 1, 4))
    before = Window.partitionBy("y").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("y", "bucket").agg(F.count("*").alias("k"))
    totals = totals.withColumns(
        {
            "off": F.coalesce(F.sum("k").over(before), F.lit(0)),
            "n": F.sum("k").over(Window.partitionBy("y")),
        }
    )
    wanted = F.array(*[r.cast("bigint") for r in ranks.values()])
    totals = totals.withColumn(
        "ks", F.filter(wanted, lambda r: (r >= F.col("off")) & (r < F.col("off") + F.col("k")))
    ).where(F.size("ks") > 0)
    rank = F.col("off") + F.row_number().over(Window.partitionBy("y", "bucket").orderBy("h")) - 1
    # At most one bucket per class and wanted rank is broadcast.
    picked = rows.join(F.broadcast(totals.drop("k")), ["y", "bucket"]).withColumn("rank", rank)
    picked = picked.where(F.array_contains("ks", F.col("rank")))
    return picked.groupBy(F.col("y").alias(label), "n").agg(
        *[F.max(F.when(F.col("rank") == r.cast("bigint"), F.col("h"))).alias(name) for name, r in ranks.items()]
    )


def numbered(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Rows with their 0-based place in the order of the given columns.

    Rows are range-partitioned, written, and numbered inside each range; the rows of earlier ranges
    are added. No task holds more than its range, whatever the size of the table. Written ranges
    stay the same when a task runs again.
    """
    path = scratch_path(df.sparkSession, "numbered")
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = df.sparkSession.read.schema(ranged.schema).parquet(path)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per writing task.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return rows.join(F.broadcast(offsets), "_range").withColumn(name, place).drop("_range", "_before")
