"""Scores of a 0/1 forecast.

All functions take (y, p) labels and classes, or a probability, with an optional weight column: the
number of equal rows a counted row stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skygrid.functions.constants import DEFAULT_THRESHOLD, THRESHOLD_RANGE
from skygrid.functions.scalars import safe_ratio
from skygrid.operators.ranks import running_before


def _w(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1).cast("bigint")


def confusion(
    df: DataFrame, y: str = "Rain", p: str = "predicted_rain", weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """tp, fp, fn, tn."""

    def cell(actual: int, said: int) -> Column:
        hit = (F.col(y) == actual) & (F.col(p) == said)
        return F.coalesce(F.sum(F.when(hit, _w(weight)).otherwise(F.lit(0).cast("bigint"))), F.lit(0))

    return df.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )


def scores(counts: DataFrame) -> DataFrame:
    """Adds accuracy, precision, recall and F1 to confusion counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": safe_ratio(tp + tn, tp + fp + fn + tn),
            "precision": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, tp + fn),
            "f1": safe_ratio(tp * 2, tp * 2 + fp + fn),
        }
    )


def roc_auc(
    df: DataFrame, y: str = "Rain", prob: str = "rain_probability", weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Exact area under the ROC curve, equal scores counting half; null with one class only.

    ``by`` names few groups known while planning, such as models.
    """
    w = _w(weight)
    zero = F.lit(0).cast("bigint")
    points = df.groupBy(*by, F.col(prob).alias("x")).agg(
        F.sum(F.when(F.col(y) == 1, w).otherwise(zero)).alias("pos"),
        F.sum(F.when(F.col(y) == 0, w).otherwise(zero)).alias("neg"),
    )
    points = points.where(F.col("x").isNotNull())
    ranked = running_before(points, ["pos", "neg"], by)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return ranked.groupBy(*by).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def report(df: DataFrame, y: str = "Rain", p: str = "predicted_rain", weight: str | None = None) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support, and the accuracy."""
    c = confusion(df, y, p, weight)
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))

    def line(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            safe_ratio(hit, hit + false_hit).alias("precision"),
            safe_ratio(hit, hit + miss).alias("recall"),
            safe_ratio(hit * 2, hit * 2 + false_hit + miss).alias("f1"),
            (hit + miss).cast("bigint").alias("support"),
        )

    c = c.withColumns({"zero": line("0", tn, fn, fp), "one": line("1", tp, fp, fn)})
    n = F.col("zero.support") + F.col("one.support")

    def mean(name: str, weighted: bool) -> Column:
        a, b = (F.col(f"{k}.support") if weighted else F.lit(1) for k in ("zero", "one"))
        parts = [
            safe_ratio(F.col(f"zero.{m}") * a + F.col(f"one.{m}") * b, a + b).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(name).alias("class"), *parts, n.alias("support"))

    hit_rate = safe_ratio(tp + tn, tp + fp + fn + tn)
    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        hit_rate.alias("precision"),
        hit_rate.alias("recall"),
        hit_rate.alias("f1"),
        n.alias("support"),
    )
    lines = F.array(
        F.col("zero"), F.col("one"), accuracy, mean("macro avg", False), mean("weighted avg", True)
    )
    return c.select(F.inline(lines))


def prevalence_columns() -> list[Column]:
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    true, said = safe_ratio(F.col("tp") + F.col("fn"), n), safe_ratio(F.col("tp") + F.col("fp"), n)
    return [
        true.alias("rain_prevalence_true"),
        said.alias("rain_prevalence_pred"),
        F.abs(true - said).alias("prevalence_drift"),
        n.alias("total_points"),
    ]


def prevalence(counts: DataFrame) -> DataFrame:
    """True and predicted share of rain, and how far apart they are."""
    return counts.select(*prevalence_columns())


def class_weights(df: DataFrame, y: str = "Rain") -> DataFrame:
    """Dry rows per rainy row, and the balanced weight of each class."""
    n0, n1 = F.count_if(F.col(y) == 0), F.count_if(F.col(y) == 1)
    n = n0 + n1
    return df.agg(
        n0.alias("n_neg"),
        n1.alias("n_pos"),
        (n0 / F.greatest(n1, F.lit(1))).alias("scale_pos_weight"),
        F.try_divide(n.cast("double"), n0 * 2).alias("weight_0"),
        F.try_divide(n.cast("double"), n1 * 2).alias("weight_1"),
    )


def _threshold_values() -> list[float]:
    low, high, n = THRESHOLD_RANGE
    step = (high - low) / (n - 1)
    return [low + step * i for i in range(n - 1)] + [high]


def threshold_curve(df: DataFrame, y: str = "Rain", prob: str = "rain_probability", weight: str | None = None) -> DataFrame:
    """F1 at each of the 41 thresholds.

    Every row falls into the slot of the highest threshold it reaches; the counts of a threshold
    are the sums over its slot and those above, so rows are read once and 42 slots are summed.
    """
    values = _threshold_values()
    low, high, n = THRESHOLD_RANGE
    p = F.col(prob)
    # The slot by arithmetic, then put right against the exact thresholds on either side.
    exact = F.array(*[F.lit(v) for v in values])
    guess = F.floor((p - F.lit(low)) / F.lit((high - low) / (n - 1))).cast("int")
    guess = F.greatest(F.lit(-1), F.least(guess, F.lit(n - 1)))
    up = (guess < n - 1) & (F.get(exact, guess + 1) <= p)
    down = (guess >= 0) & (F.get(exact, guess) > p)
    slot = F.when(up, guess + 1).when(down, guess - 1).otherwise(guess)
    w, zero = _w(weight), F.lit(0).cast("bigint")
    slots = (
        df.where(p.isNotNull())
        .groupBy(slot.alias("slot"))
        .agg(
            F.sum(F.when(F.col(y) == 1, w).otherwise(zero)).alias("pos"),
            F.sum(F.when(F.col(y) == 0, w).otherwise(zero)).alias("neg"),
        )
    )
    every = df.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("slot"))
    slots = every.join(F.broadcast(slots), "slot", "left")
    from_here = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy()
    counts = slots.select(
        "slot",
        F.coalesce(F.sum("pos").over(from_here), zero).alias("tp"),
        F.coalesce(F.sum("neg").over(from_here), zero).alias("fp"),
        F.coalesce(F.sum("pos").over(total), zero).alias("all_pos"),
    ).where(F.col("slot") >= 0)
    fn = F.col("all_pos") - F.col("tp")
    return counts.select(
        F.get(exact, F.col("slot")).alias("threshold"),
        "tp",
        "fp",
        fn.alias("fn"),
        safe_ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + fn).alias("f1"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The lowest threshold of the highest F1; the default where none is above 0."""
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("neg")))
    return curve.agg(best.alias("b")).select(
        F.when(F.col("b.f1") > 0, -F.col("b.neg")).otherwise(DEFAULT_THRESHOLD).alias("threshold"),
        F.coalesce("b.f1", F.lit(0.0)).alias("f1"),
    )


def compare_models(df: DataFrame, models: dict[str, Column], y: str, threshold: float = 0.5) -> DataFrame:
    """One row of scores per model; ``models`` maps a name to its probability column.

    Equal probabilities are counted together first, once for all models.
    """
    long = df.select(
        F.col(y).alias("y"),
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("model"), c.alias("p")) for m, c in models.items()])
        ),
    )
    counted = long.groupBy("model", "p", "y").agg(F.count("*").alias("w"))
    said = counted.withColumn("said", (F.col("p") >= F.lit(threshold)).cast("int"))
    table = scores(confusion(said, "y", "said", "w", ["model"]))
    return table.join(F.broadcast(roc_auc(said, "y", "p", "w", ["model"])), "model")  # one row each
