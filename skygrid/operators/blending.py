"""Weighted means of three probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions.constants import BLEND_WEIGHTS, DEFAULT_THRESHOLD
from skygrid.functions.scalars import safe_ratio
from skygrid.operators.metrics import compare_models


def blend(weights: Sequence[float], probs: Sequence[str]) -> Column:
    terms = [F.lit(float(w)) * F.col(p) for w, p in zip(weights, probs)]
    return sum(terms[1:], terms[0])


def compare_blends(df: DataFrame, probs: Sequence[str], label: str = "Rain", sets=BLEND_WEIGHTS) -> DataFrame:
    """Scores of each fixed weight set, cut at 0.5."""
    models = {f"blend_{i + 1}": blend(w, probs) for i, w in enumerate(sets)}
    return compare_models(df, models, label, DEFAULT_THRESHOLD)


#: Last probabilities closer than this, with a blend as close to the threshold, are tried at every
#: weight: rounding alone may turn their class.
CLOSE = 1e-6


def search_blend(df: DataFrame, probs: Sequence[str], label: str = "Rain", points: int = 101) -> DataFrame:
    """F1 of every weight combination: (idx, w_0, w_1, w_2, tp, fp, f1).

    For a given first weight the blend is linear in the second, so a row's class turns at one value of
    it. A row adds to a difference table there, and sums over that table give the counts of all second
    weights: a few updates per first weight in place of one per combination. The place is found by
    division and settled by the blend itself, so rounding is that of a plain comparison. What is
    shuffled is at most one row per combination, class and task.

    Rows without a class of 0 or 1 are not counted; rows with a null or NaN probability count as dry
    forecasts. An empty table gives every combination with zeros.
    """
    p0, p1, p2 = (F.nanvl(F.col(p).cast("double"), F.lit(None).cast("double")) for p in probs)
    last = points - 1
    rows = df.where(F.col(label).isin(0, 1)).select(F.col(label).alias("y"), p0.alias("p0"), p1.alias("p1"), p2.alias("p2"))
    half, a, i = F.lit(DEFAULT_THRESHOLD), F.col("a"), F.col("i")
    first_weight = F.when(i == last, 1.0).otherwise(i * F.lit(1.0 / last))

    def by_weight(some: DataFrame) -> DataFrame:
        return some.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn("a", first_weight)

    def blended(j: Column) -> Column:
        b = F.when(j == last, 1 - a).otherwise(j * ((1 - a) / last))
        return F.col("p0") * a + F.col("p1") * b + F.col("p2") * (1 - a - b)

    def said(j: Column) -> Column:
        return F.coalesce(blended(j) >= half, F.lit(False))

    # Rows of nearly equal last probabilities whose blend is at the threshold itself.
    close = F.abs(F.col("p1") - F.col("p2")) < CLOSE
    tight = F.coalesce(close & (F.abs(blended(F.lit(0)) - half) < 2 * CLOSE) & (a < 1), F.lit(False))
    slope = (F.col("p1") - F.col("p2")) * ((1 - a) / last)
    turn = (half - F.col("p0") * a - F.col("p2") * (1 - a)) / F.nullif(slope, F.lit(0.0))
    near = F.floor(F.least(F.greatest(turn, F.lit(0.0)), F.lit(float(last)))).cast("int")
    plain = by_weight(rows).where(~tight).select("*", near.alias("near"), said(F.lit(0)).alias("start"), said(F.lit(last)).alias("end"))
    place = F.least(F.col("near") + 2, F.lit(last))
    for ahead in (1, 0, -1):  # the earliest place that differs is written outermost
        at = F.least(F.greatest(F.col("near") + ahead, F.lit(1)), F.lit(last))
        place = F.when(said(at) != F.col("start"), at).otherwise(place)
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    # At the last weight every row is counted once as place -1: the positives.
    steps = F.array(
        F.struct(F.lit(0).alias("j"), start.alias("d")),
        F.struct(place.alias("j"), (end - start).alias("d")),
        F.struct(F.lit(-1).alias("j"), (i == last).cast("int").alias("d")),
    )
    turned = plain.select("y", "i", F.inline(steps))
    tried = by_weight(rows.where(close)).where(tight).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(last))))
    was = F.when(F.col("j") > 0, said(F.col("j") - 1)).otherwise(False)
    tried = tried.select("y", "i", "j", (said(F.col("j")).cast("int") - was.cast("int")).alias("d"))
    steps = turned.unionByName(tried).where("d <> 0")
    counted = steps.groupBy("i", "j").agg(*[F.sum(F.when(F.col("y") == y, F.col("d")).otherwise(0)).alias(n) for n, y in (("tp", 1), ("fp", 0))])
    grid = df.sparkSession.range(points * points).select((F.col("id") / points).cast("int").alias("i"), (F.col("id") % points).cast("int").alias("j"), F.col("id").cast("int").alias("idx"))
    grid = grid.unionByName(df.sparkSession.range(1).select(F.lit(last).alias("i"), F.lit(-1).alias("j"), F.lit(-1).alias("idx")))
    w_0 = F.when(i == last, 1.0).otherwise(i * F.lit(1.0 / last))
    w_1 = F.when(F.col("j") == last, 1 - F.col("w_0")).otherwise(F.col("j") * ((1 - F.col("w_0")) / last))
    so_far = Window.partitionBy("i").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    table = grid.join(counted, ["i", "j"], "left").withColumn("w_0", w_0).withColumn("w_1", w_1).withColumn("w_2", 1 - F.col("w_0") - F.col("w_1"))
    # One row per combination.
    table = table.withColumn("positives", F.coalesce(F.max(F.when(F.col("j") < 0, F.col("tp"))).over(Window.partitionBy(F.lit(0))), F.lit(0)))
    table = table.where("j >= 0").withColumns({n: F.coalesce(F.sum(n).over(so_far), F.lit(0)) for n in ("tp", "fp")})
    f1 = safe_ratio(F.col("tp") * 2, F.col("tp") + F.col("fp") + F.col("positives"))
    return table.select("idx", "w_0", "w_1", "w_2", "tp", "fp", f1.alias("f1"))


def best_blend(found: DataFrame) -> DataFrame:
    best = F.max_by(F.struct("w_0", "w_1", "w_2", "f1"), F.struct("f1", -F.col("idx")))
    return found.where(F.col("f1") > 0).agg(best.alias("b")).select("b.*")
