"""Exact duplicates by a log-structured merge index over text digests.

Level 0: each task puts (digest -> smallest identifier, count) into a memtable and,
when that is full and at the end, flushes it as a sorted run, cut into ranges of
the digest space, each slice with a Bloom filter of its digests.  Compaction: the
slices of a range meet in one task; their filters tell which digests can lie in
two runs, only these are merged, and each keeps its smallest identifier.  A hot
digest arrives once per run, never once per row.  Byte verification: the texts of
all hits are compared per digest with map-side minima and maxima; digests whose
texts differ are regrouped by the text itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import IdFilter
from .stage import frugal, written
from .textvec import mix

LAST = np.iinfo(np.int64).max
_LEVEL0 = "kind int, doc_id long, run long, pos long, digest binary, range int, digests binary, keys binary, counts binary, filter binary"


def normalised(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null is empty."""
    return b"" if text is None else text.encode("utf-8").lower()


def _bloom(digests: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap (as bools) of 2**bits positions, two for each digest."""
    out = np.zeros(1 << bits, bool)
    for at in _at(digests, bits):
        out[at] = True
    return out


def _at(digests: np.ndarray, bits: int) -> list[np.ndarray]:
    words = np.ascontiguousarray(digests[:, -8:]).view(np.uint64).ravel()
    mask = np.uint64((1 << bits) - 1)
    return [(words & mask).astype(np.int64), (mix(words) & mask).astype(np.int64)]


def _flush(memtable: dict, run: int, ranges: int, width: int):
    """Rows of level 0 for one sorted run."""
    digests = sorted(memtable)
    table = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, width)
    keys = np.array([memtable[d][0] for d in digests], np.int64).reshape(-1, 3)
    counts = np.array([memtable[d][1] for d in digests], np.int64)
    head = np.zeros((len(table), 4), np.uint8)
    head[:, : min(4, width)] = table[:, :4]
    where = (head.view(">u4").ravel().astype(np.int64) * ranges) >> 32
    cuts = np.searchsorted(where, np.arange(ranges + 1))
    for r in range(ranges):
        a, b = int(cuts[r]), int(cuts[r + 1])
        if b > a:
            bits = max(6, int(8 * (b - a) - 1).bit_length())
            wide = table[a:b] if width >= 8 else np.pad(table[a:b], ((0, 0), (8 - width, 0)))
            yield r, table[a:b].tobytes(), keys[a:b].tobytes(), counts[a:b].tobytes(), np.packbits(_bloom(wide, bits)).tobytes()


def _level0(largest: bool, ranges: int, memtable_entries: int, width: int):
    def task(batches):
        from pyspark import TaskContext

        part, seq, pos, memtable = TaskContext.get().partitionId(), 0, 0, {}

        def flushed():
            rows = list(_flush(memtable, 0, ranges, width))
            n = len(rows)
            run = (part << 24) | seq
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            none = [None] * n
            return pa.record_batch([pa.array([1] * n, pa.int32()), pa.array(none, pa.int64()), pa.array([run] * n, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.binary()), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)

        names = [x.split()[0] for x in _LEVEL0.split(", ")]
        for batch in batches:
            ids, runs, places, shas = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(memtable) >= memtable_entries:
                    yield flushed()
                    memtable.clear()
                    seq += 1
                run = (part << 24) | seq
                sha = hashlib.sha256(normalised(text)).digest()
                key = ((LAST if doc_id is None else ~doc_id if largest else doc_id), run, pos)
                if (old := memtable.get(sha[:width])) is None:
                    memtable[sha[:width]] = [key, 1]
                else:
                    old[1] += 1
                    if key < old[0]:
                        old[0] = key
                ids.append(doc_id)
                runs.append(run)
                places.append(pos)
                shas.append(sha)
                pos += 1
            n = len(ids)
            none = pa.array([None] * n, pa.binary())
            yield pa.record_batch([pa.array([0] * n, pa.int32()), pa.array(ids, pa.int64()), pa.array(runs, pa.int64()), pa.array(places, pa.int64()), pa.array(shas, pa.binary()), pa.array([None] * n, pa.int32()), none, none, none, none], names=names)
        if memtable:
            yield flushed()

    return task


def _merged(slices: list[tuple], width: int):
    """Hits of one range: for each run that holds a digest met at least twice, the smallest key and the group's size."""
    bits = max(len(s[4]) * 8 for s in slices).bit_length() - 1
    once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
    for s in slices:
        bitmap = np.unpackbits(np.frombuffer(s[4], np.uint8)).astype(bool)
        bitmap = np.tile(bitmap, (1 << bits) // len(bitmap))
        twice |= once & bitmap
        once |= bitmap
    runs, digests, keys, counts = [], [], [], []
    for run, d, k, c, _ in slices:
        table = np.frombuffer(d, np.uint8).reshape(-1, width)
        n = np.frombuffer(c, np.int64)
        wide = table if width >= 8 else np.pad(table, ((0, 0), (8 - width, 0)))
        maybe = n > 1
        one, two = _at(wide, bits)
        maybe |= twice[one] & twice[two]
        runs.append(np.full(int(maybe.sum()), run, np.int64))
        digests.append(table[maybe])
        keys.append(np.frombuffer(k, np.int64).reshape(-1, 3)[maybe])
        counts.append(n[maybe])
    runs, digests, keys, counts = (np.concatenate(x) for x in (runs, digests, keys, counts))
    if not len(runs):
        return None
    _, group = np.unique(np.array([x.tobytes() for x in digests], object), return_inverse=True)
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0], group))
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    least = keys[order[first]]
    size = np.bincount(group, weights=counts).astype(np.int64)
    hit = size[group] > 1
    return runs[hit], [digests[i].tobytes() for i in np.flatnonzero(hit)], least[group[hit]], size[group[hit]]


def _compact(width: int):
    def task(batches):
        held, at = [], None

        def out():
            got = _merged(held, width)
            if got is not None:
                runs, digests, keys, sizes = got
                yield pa.record_batch([pa.array(runs), pa.array(digests, pa.binary()), *[pa.array(np.ascontiguousarray(keys[:, i])) for i in range(3)], pa.array(sizes)], names=["run", "key", "keep", "keep_run", "keep_pos", "group_size"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[0] != at:
                    if held:
                        yield from out()
                    held, at = [], row[0]
                held.append(row[1:])
        if held:
            yield from out()

    return task


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", memtable_entries: int = 1 << 16, range_rows: int = 200_000, digest_bytes: int = 32) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when the same after lower-casing A-Z; null counts as empty.  ``keep``
    is "smallest" or "largest": for the latter the index orders identifiers by their
    complement, so that the smallest key is the largest identifier.  A null identifier
    stays only where all in its group are null; of rows with the same identifier and
    text, the first read stays.  An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranges = max(1, -(-docs.count() // range_rows))
    largest = keep == "largest"
    level0 = written(docs.mapInArrow(frugal(_level0(largest, ranges, memtable_entries, digest_bytes)), _LEVEL0), "lsm-level0")
    slices = level0.where("kind = 1").select("range", "run", "digests", "keys", "counts", "filter")
    hits = written(slices.repartition("range").sortWithinPartitions("range", "run").mapInArrow(frugal(_compact(digest_bytes)), "run long, key binary, keep long, keep_run long, keep_pos long, group_size long"), "lsm-hits")
    rows = level0.where("kind = 0").select("doc_id", "run", "pos", "digest", F.substring("digest", 1, digest_bytes).alias("key"))
    out = rows.join(hits, ["run", "key"], "left")

    wanted = IdFilter.build(hits.select(F.xxhash64("key").alias("h")), "h")
    words = spark.sparkContext.broadcast(wanted.words)
    texts = docs.mapInArrow(frugal(_hit_texts(words, digest_bytes)), "doc_id long, key binary, text binary")
    unlike = texts.groupBy("key").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("key")
    unlike = written(unlike, "lsm-unlike")
    value = (lambda c: -F.col(c) - 1) if largest else F.col
    kept_id = F.when(F.col("keep") != LAST, value("keep"))
    result = out.select("doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(kept_id).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce((F.col("run") == F.col("keep_run")) & (F.col("pos") == F.col("keep_pos")), F.lit(True)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "key", "run", "pos")
    if unlike.limit(1).count():
        # Different texts under one digest: these groups are formed anew, by full digest and bytes.
        order = F.struct(F.coalesce(value("doc_id") if largest else F.col("doc_id"), F.lit(LAST)).alias("k"), "run", "pos")
        real = texts.join(unlike, "key").select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"))
        sure = real.groupBy("text", "text_sha256").agg(F.count("*").alias("group_size"))
        # Texts that even share the full digest can't be told apart from rows without text, so they are refused.
        if sure.groupBy("text_sha256").count().where("count > 1").limit(1).count():
            raise ValueError("different texts share a SHA-256 digest")
        bad = result.join(unlike, "key").select("doc_id", "text_sha256", "run", "pos")
        best = bad.groupBy("text_sha256").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
        bad = bad.join(best, "text_sha256").select("doc_id", F.when(F.col("best.k") != LAST, -F.col("best.k") - 1 if largest else F.col("best.k")).alias("keep_id"), "group_size", ((F.col("run") == F.col("best.run")) & (F.col("pos") == F.col("best.pos"))).alias("kept"), "text_sha256")
        result = result.join(unlike, "key", "left_anti").select(bad.columns).unionByName(bad)
    return result.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _hit_texts(words, width: int):
    def task(batches):
        wanted = IdFilter(words.value)
        for batch in batches:
            digests, texts = [], []
            ids = batch.column(0)
            for text in batch.column(1).to_pylist():
                raw = normalised(text)
                texts.append(raw)
                digests.append(hashlib.sha256(raw).digest()[:width])
            keep = np.flatnonzero(wanted.passes(_xxhash64(digests)))
            yield pa.record_batch([ids.take(pa.array(keep)), pa.array([digests[i] for i in keep], pa.binary()), pa.array([texts[i] for i in keep], pa.binary())], names=["doc_id", "key", "text"])

    return task


def _xxhash64(values: list[bytes]) -> np.ndarray:
    """Spark's xxhash64 of binary values."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(v, seed=42) for v in values], np.uint64).view(np.int64)
