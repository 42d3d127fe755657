"""Joins and filters whose broadcast side has a proven bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import frugal

SHARE = 1000


def attach(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of rows with a table of unique keys, of which ``count`` says how many rows each has.

    A key with more than 1/SHARE of all rows is hot; there are fewer than SHARE such
    keys, whatever the data, so they are broadcast.  The others are shuffled.
    """
    if total < SHARE:
        return rows.join(table.drop(count), key)
    hot = F.col(count) * SHARE > total
    few = F.broadcast(table.where(hot).drop(count))
    return rows.join(few, key).unionByName(rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(table.where(~hot).drop(count), key))


class IdFilter:
    """A Bloom filter over 64-bit values, sized by their count: 2**LARGEST bits (16 MB) at most.

    Its words are folded together on the executors, so the driver gets 2**(LARGEST-6)
    longs at most.  Beyond about 2**LARGEST / 8 values it only passes more, never less.
    """

    HASHES, SMALLEST, LARGEST = 4, 16, 27

    def __init__(self, words: np.ndarray):
        self.words = words
        self.bits = len(words).bit_length() + 5

    @staticmethod
    def _positions(values: np.ndarray, bits: int) -> list[np.ndarray]:
        from .textvec import mix

        h = mix(values.astype(np.uint64))
        step = (h >> np.uint64(32)) | np.uint64(1)
        return [(h + np.uint64(k) * step) & np.uint64((1 << bits) - 1) for k in range(IdFilter.HASHES)]

    @classmethod
    def build(cls, df: DataFrame, column: str, bits: int | None = None) -> IdFilter:
        """Of the non-null bigint values of a column."""
        if bits is None:
            bits = min(cls.LARGEST, max(cls.SMALLEST, (10 * df.select(column).count()).bit_length()))

        def words(batches):
            own = np.zeros(1 << (bits - 6), np.uint64)
            for batch in batches:
                values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for at in cls._positions(values, bits):
                    np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
            some = np.flatnonzero(own)
            for a in range(0, len(some), 1 << 18):
                yield pa.record_batch([pa.array(some[a : a + (1 << 18)].astype(np.int64)), pa.array(own[some[a : a + (1 << 18)]].view(np.int64))], names=["at", "word"])

        got = df.select(column).mapInArrow(frugal(words), "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
        out = np.zeros(1 << (bits - 6), np.uint64)
        out[got["at"].to_numpy()] = got["word"].to_numpy().view(np.uint64)
        return cls(out)

    def passes(self, values: np.ndarray) -> np.ndarray:
        ok = np.ones(len(values), bool)
        for at in self._positions(values.view(np.uint64), self.bits):
            ok &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return ok


def parted(rows: DataFrame, id_col: str, wanted: IdFilter) -> tuple[DataFrame, DataFrame]:
    """(rows whose identifier is surely not in the filter, the others); null identifiers are among the others.

    So a join on few identifiers need not shuffle the many rows that it can't touch.
    """
    words = rows.sparkSession.sparkContext.broadcast(wanted.words)

    @F.arrow_udf("boolean")
    def may(ids: pa.Array) -> pa.Array:
        ok = IdFilter(words.value).passes(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.array(ok | ids.is_null().to_numpy(zero_copy_only=False))

    flagged = may(F.col(id_col).cast("bigint"))
    return rows.where(~flagged), rows.where(flagged)
