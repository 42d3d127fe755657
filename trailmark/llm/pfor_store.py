"""Token-id files of patched frame-of-reference blocks.

A shard is one binary file: header, document identifiers and lengths, an index of block starts,
then blocks of BLOCK ids.  A block holds its minimum, the bit width that a percentile of its
offsets from the minimum needs, the offsets packed at that width, and its outliers as
lists of positions and high parts.  Shards are files of their own below ``shards``, each under a new name, and a
Parquet table ``manifest`` lists them in ascending order of documents.  Spark commits the manifest as a whole, with the
files of the attempts that count, so what a lost executor has left behind is never read.
The folder is a path or URI of any file system that Arrow knows (local or shared mounts, HDFS, S3, GCS).
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_encoder import WordEndEncoder, encoder
from .stage import frugal

MAGIC, BLOCK, SHARD_IDS = b"PFR1", 256, 1 << 20
#: Magic, documents, ids, blocks, bytes of identifiers and lengths.
_HEADER = struct.Struct("<4sQQQQ")


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(BLOCK, k) values to (k, words) little-endian 64-bit words."""
    out = np.zeros((BLOCK * width // 64, values.shape[1]), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[word] |= values[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= values[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """(k, words) to (BLOCK, k) values."""
    words = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, words.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        v = words[word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (words[word + 1] << np.uint64(64 - shift))
        out[i] = v & mask
    return out


def encode_ids(ids: np.ndarray, percentile: float = 98.0) -> tuple[bytes, np.ndarray]:
    """The blocks of uint32 ids, and the start of each block in them with the end as last entry."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", np.zeros(1, np.int64)
    table = np.empty(blocks * BLOCK, np.uint64)
    table[:n] = ids
    table[n:] = ids[-1]
    table = table.reshape(blocks, BLOCK)
    least = table.min(axis=1)
    table = table - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    width = _bit_length(np.partition(table, rank, axis=1)[:, rank])
    out: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        part = table[rows]
        low = part & np.uint64((1 << w) - 1)
        words = _pack(low.T, w) if w else np.zeros((len(rows), 0), np.uint64)
        high = part >> np.uint64(w)
        for k, r in enumerate(rows.tolist()):
            at = np.flatnonzero(high[k])
            out[r] = struct.pack("<IBH", int(least[r]), w, len(at)) + words[k].tobytes() + at.astype("<u2").tobytes() + high[k][at].astype("<u4").tobytes()
    return b"".join(out), np.cumsum([0, *map(len, out)])


def decode_ids(data: bytes | memoryview, starts: np.ndarray, n: int) -> np.ndarray:
    """The first n ids of blocks at the given starts, relative to data."""
    blocks = len(starts) - 1
    table = np.empty((blocks, BLOCK), np.uint64)
    heads = [struct.unpack_from("<IBH", data, s) for s in starts[:-1].tolist()]
    width = np.array([h[1] for h in heads], np.int64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        words = BLOCK * w // 64
        if w:
            raw = np.stack([np.frombuffer(data, "<u8", words, int(starts[r]) + 7) for r in rows.tolist()])
            table[rows] = _unpack(raw, w).T
        else:
            table[rows] = 0
    for r, (least, w, outliers) in enumerate(heads):
        if outliers:
            at = int(starts[r]) + 7 + BLOCK * w // 8
            where = np.frombuffer(data, "<u2", outliers, at)
            table[r, where] |= np.frombuffer(data, "<u4", outliers, at + 2 * outliers).astype(np.uint64) << np.uint64(w)
        table[r] += np.uint64(least)
    return table.ravel()[:n].astype(np.uint32)


def write_shard(doc_ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    """One file of the given documents, in order."""
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    blocks, starts = encode_ids(ids)
    own = np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes()
    none = np.packbits([i is None for i in doc_ids]).tobytes() if doc_ids else b""
    lengths = np.array([len(d) for d in documents], "<u8").tobytes()
    meta = own + none + lengths
    return _HEADER.pack(MAGIC, len(doc_ids), len(ids), len(starts) - 1, len(meta)) + meta + starts.astype("<u8").tobytes() + blocks


def read_shard(data: bytes, first: int = 0, last: int | None = None):
    """(doc_id, offset of its first id in the shard, uint32 ids) of documents first to last; only their blocks are decoded."""
    magic, docs, n, blocks, meta = _HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token-id file")
    at = _HEADER.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    none = np.unpackbits(np.frombuffer(data, np.uint8, -(-docs // 8), at + 8 * docs))[:docs].astype(bool)
    lengths = np.frombuffer(data, "<u8", docs, at + 8 * docs + -(-docs // 8)).astype(np.int64)
    at += meta
    starts = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64) + at + 8 * (blocks + 1)
    ends = np.cumsum(lengths)
    last = docs if last is None else min(last, docs)
    if first >= last:
        return
    lo = int(ends[first] - lengths[first])
    hi = int(ends[last - 1])
    a, b = lo // BLOCK, -(-hi // BLOCK)
    ids = decode_ids(data, starts[a : b + 1], min(n, b * BLOCK) - a * BLOCK) if b > a else np.zeros(0, np.uint32)
    for k in range(first, last):
        begin = int(ends[k] - lengths[k])
        yield None if none[k] else int(doc_ids[k]), begin, ids[begin - a * BLOCK : int(ends[k]) - a * BLOCK]


MANIFEST = "part int, shard long, before long, n_docs long, n_ids long, name string"


def _write(path: str, folder: str, end_id: int):
    def task(batches):
        from pyspark import TaskContext

        part, serial, before = TaskContext.get().partitionId(), 0, 0
        system, inner = fs.FileSystem.from_uri(folder)
        doc_ids: list = []
        documents: list[np.ndarray] = []
        size = 0

        def shard():
            nonlocal serial, before, size
            name = f"{part:06d}-{serial:06d}-{uuid.uuid4().hex}.pfr"
            with system.open_output_stream(f"{inner}/shards/{name}") as f:
                f.write(write_shard(doc_ids, documents))
            out = pa.record_batch([pa.array([x], t) for x, t in ((part, pa.int32()), (serial, pa.int64()), (before, pa.int64()), (len(doc_ids), pa.int64()), (size, pa.int64()), (name, pa.string()))], names=[x.split()[0] for x in MANIFEST.split(", ")])
            serial, before, size = serial + 1, before + size, 0
            doc_ids.clear()
            documents.clear()
            return out

        with encoder(WordEndEncoder, path) as enc:
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(x.as_py() for x in batch.column(1)), strict=True):
                    if not serial and not documents:
                        system.create_dir(f"{inner}/shards", recursive=True)
                    doc_ids.append(doc_id)
                    documents.append(np.append(ids, end_id).astype(np.uint32))
                    size += len(ids) + 1
                    if size >= SHARD_IDS:
                        yield shard()
            if doc_ids:
                yield shard()

    return frugal(task)


def write_ids(docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> None:
    """Write the ids of all texts, each with the end id after it, in ascending order of identifiers.

    ``vocabulary`` is the path of a word-end tokenizer file on every worker.  Null texts are empty;
    null identifiers come first; rows of one identifier are ordered by a hash of their text, so a hot
    identifier spans several tasks.  An empty table has an empty manifest; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_write(vocabulary, folder, end_id), MANIFEST).write.parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids (array) of each document in the files.

    The counts of ids before each part are a prefix sum over as many rows as the files were written by tasks.
    """
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    parts = sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    base, total = {}, 0
    for part, n in parts:
        base[part] = total
        total += n

    def task(batches):
        system, inner = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for part, before, name in zip(*[batch.column(c).to_pylist() for c in ("part", "before", "name")], strict=True):
                with system.open_input_file(f"{inner}/shards/{name}") as f:
                    data = f.read()
                rows = [(doc_id, base[part] + before + begin, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids) for doc_id, begin, ids in read_shard(data)]
                ids = [pa.array([r[4] for r in rows], pa.list_(pa.int32()))] if with_ids else []
                yield pa.record_batch([*[pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], *ids], names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    # Many shards may share one small manifest file, so they are dealt out by name.
    return shards.select("part", "before", "name").repartition("name").mapInArrow(frugal(task), schema)
