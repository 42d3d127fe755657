"""Topic streams: the same expressions as in batch, kept as state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clamped_torque


def latest(stream: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """key, value of the latest message of each topic. State is one row per topic; use update or complete mode."""
    return stream.groupBy(key).agg(F.max(F.struct(*order, value))[value].alias(value))


def voxel_state(points: DataFrame, keys: dict[str, Column], rank: Column) -> DataFrame:
    """The least rank of each voxel over all chunks so far; chunks may come in any order."""
    return points.groupBy(*[e.alias(n) for n, e in keys.items()]).agg(F.min(rank).alias("p"))


def torques(stream: DataFrame, kp: float, kd: float, target: float, limit: float) -> DataFrame:
    """Stateless control tick: torque of each message within the limit."""
    return stream.withColumn("torque", clamped_torque(F.lit(kp), F.lit(kd), F.lit(target) - F.col("value"), F.col("speed"), F.lit(limit)))


def windowed(stream: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    """Counts per tumbling window; messages later than ``late`` are dropped, and state goes with them."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))


def smoothed(stream: DataFrame, key: str, order: str, value: str, keep: float = 0.35, output: str = "smoothed") -> DataFrame:
    """Exponential smoothing from zero for each key, across batches: v = keep * v + (1 - keep) * value.

    Messages of a batch are taken in their order; state is one number per key.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(group, chunks, state):
        v = state.get[0] if state.exists else 0.0
        rows = pd.concat(list(chunks)).sort_values(order)
        for x in rows[value]:
            v = keep * v + (1 - keep) * x
        state.update((v,))
        yield pd.DataFrame({key: [group[0]], "n": [len(rows)], output: [v]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n long, {output} double", "v double", "update", GroupStateTimeout.NoTimeout)
