"""Scoring with four exported model files inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions.constants import FEATURE_ORDER, SERVING_THRESHOLD
from skygrid.functions.scalars import half_even, to_class

BASE_ORDER = ("xgb", "lgb", "cat")


def open_onnx(model: bytes):
    """One single-threaded session, as each task has one core."""
    import onnxruntime as rt

    options = rt.SessionOptions()
    options.intra_op_num_threads = 1
    options.inter_op_num_threads = 1
    options.enable_mem_pattern = False
    return rt.InferenceSession(model, options, providers=["CPUExecutionProvider"])


def rain_column(output) -> np.ndarray:
    """Class-1 probabilities from either layout: one dict per row, or an N x 2 array."""
    table = output[1]
    if isinstance(table, list):
        return np.fromiter((row[1] for row in table), dtype=np.float64, count=len(table))
    return np.asarray(table)[:, 1].astype(np.float64)


def run(session, matrix: np.ndarray) -> np.ndarray:
    return rain_column(session.run(None, {session.get_inputs()[0].name: matrix}))


def score(
    df: DataFrame,
    models: Mapping[str, bytes],
    keep: Sequence[str],
    features: Sequence[str] = FEATURE_ORDER,
    open_session: Callable = open_onnx,
) -> DataFrame:
    """``keep`` plus ``p_xgb``, ``p_lgb``, ``p_cat`` and ``prob``.

    ``models`` holds the bytes of the three bases and of ``meta``. They are broadcast once and
    opened once per task; a batch holds at most spark.sql.execution.arrow.maxRecordsPerBatch rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(dict(models))
    kept, order = list(keep), list(features)

    def batches(frames):
        sessions = {name: open_session(body) for name, body in shared.value.items()}
        for pdf in frames:
            out = pdf[kept].copy()
            if len(pdf) == 0:
                continue
            matrix = pdf[order].to_numpy(dtype=np.float32)
            base = [run(sessions[name], matrix) for name in BASE_ORDER]
            for name, p in zip(BASE_ORDER, base):
                out[f"p_{name}"] = p
            out["prob"] = run(sessions["meta"], np.column_stack(base).astype(np.float32))
            yield out

    fields = [df.schema[c] for c in kept]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
        + [f"p_{n} double" for n in BASE_ORDER]
        + ["prob double"]
    )
    return df.select(*dict.fromkeys([*kept, *order])).mapInPandas(batches, schema)


def to_forecast(
    scored: DataFrame, threshold: float = SERVING_THRESHOLD, time: str = "Timestamp", keep: Sequence[str] = ()
) -> DataFrame:
    """Scored rows to the five forecast columns (and those to ``keep``)."""
    return scored.select(
        F.col(time).alias("Forecast_Target_Time"),
        "Latitude",
        "Longitude",
        half_even("prob", 4).alias("rain_probability"),
        to_class("prob", threshold).alias("predicted_rain"),
        *keep,
    )


