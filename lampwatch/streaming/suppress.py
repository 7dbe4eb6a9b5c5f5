"""K5 streaming: per sensor one state row with the time of the last *sent*
alert; each micro-batch's alerts of a sensor are applied in time order with
the same greedy chain as the batch form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampwatch import labels as L
from lampwatch.functions import timefns as tf
from lampwatch.operators.suppress import greedy_keep

LAST_SENT = T.StructType([T.StructField("last_sent", T.LongType())])
OUTPUT = T.StructType([T.StructField("key", T.StringType()),
                       T.StructField("time_stamp", T.LongType())])


def suppress_group_fn(gap_ms: int = L.ALERT_GAP_S * 1000):
    """``applyInPandasWithState`` function: the sensor's alerts of this
    micro-batch in time order, seeded with the last sent time."""
    def fn(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        frames = list(frames)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        ts = np.sort(batch["time_stamp"].to_numpy(dtype=np.int64), kind="stable")
        last = state.get[0] if state.exists else None
        sent = ts[greedy_keep(ts, gap_ms, last)]
        if len(sent):
            state.update((int(sent[-1]),))
            yield pd.DataFrame({"key": pd.Series([key[0]] * len(sent), dtype=object),
                                "time_stamp": pd.Series(sent, dtype=np.int64)})
    return fn


def suppress_stream(alerts: DataFrame, start, key: str = "key",
                    ts_ms: str = "time_stamp") -> DataFrame:
    """Sent alerts of a stream of ``(key, time_stamp)`` alerts."""
    start_ms = start * 1000 if start < L.EPOCH_SECONDS_LIMIT else start
    norm = (alerts.select(F.col(key).alias("key"), tf.epoch_ms(ts_ms).alias("time_stamp"))
            .where(F.col("time_stamp") >= F.lit(start_ms)))
    return norm.groupBy("key").applyInPandasWithState(
        suppress_group_fn(), outputStructType=OUTPUT, stateStructType=LAST_SENT,
        outputMode="append", timeoutConf="NoTimeout")
