"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents are tokenised; full windows of long ones are sequences at once, and what is left of each document, whole, is
gathered into groups of about GROUP windows.  A group starts as one partial partition for each
item; again and again the two with the largest spread merge, the largest sum of one with the smallest of the
other, until one partition into near-equal windows is left.  While its largest window exceeds
the capacity, the window count rises, by one in RISE windows at most; then only the windows that still exceed it
are cut, and what they have too much fills others.  So most documents of less than a window
stay whole, and a group has hardly more padding than the last window.  No shuffle: groups lie within a task.
"""

from __future__ import annotations

import heapq
import zlib
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk_encoder import ByteLevelEncoder, encoder
from .stage import frugal

GROUP, RISE = 96, 96
_sum = itemgetter(0)
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of sizes dealt to windows of near-equal sums, by the largest differencing method."""
    # A partial partition lists its windows that hold something, largest first; the others are empty.
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    if not heap:
        return [[] for _ in range(windows)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) + len(b) > windows:
            met = [(a[k][0] + b[windows - 1 - k][0], a[k][1] + b[windows - 1 - k][1]) for k in range(windows - len(b), len(a))]
            both = a[: windows - len(b)] + met + b[: windows - len(a)]
        else:
            both = a + b
        both.sort(key=_sum, reverse=True)
        spread = both[0][0] - (both[-1][0] if len(both) == windows else 0)
        heapq.heappush(heap, (-spread, serial, both))
        serial += 1
    got = [items for _, items in heap[0][2]]
    return got + [[] for _ in range(windows - len(got))]


def pack(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of at most capacity, as (index of the item, first of its units, units); an item lies in one window unless that had to be cut."""
    windows = least = max(1, -(-sum(sizes) // capacity))
    while True:
        got = differencing(sizes, windows)
        sums = [sum(sizes[i] for i in w) for w in got]
        if max(sums, default=0) <= capacity or (windows - least + 1) * RISE > least:
            break
        windows += 1
    out = [[(i, 0, sizes[i]) for i in w] for w in got]
    rooms = [(total - capacity, k) for k, total in enumerate(sums) if total < capacity]
    heapq.heapify(rooms)
    for k in sorted(range(len(out)), key=sums.__getitem__, reverse=True):
        over = sums[k] - capacity
        if over <= 0:
            break
        out[k].sort(key=itemgetter(2))
        while over:
            i, begin, n = out[k].pop()
            stay = max(0, n - over)
            over -= n - stay
            if stay:
                out[k].append((i, begin, stay))
            while stay < n:
                room, to = heapq.heappop(rooms)
                moved = min(n - stay, -room)
                out[to].append((i, begin + stay, moved))
                stay += moved
                if moved < -room:
                    heapq.heappush(rooms, (room + moved, to))
    return [w for w in out if w]


def _task(path: str, capacity: int, end_id: int):
    def task(batches):
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 40
        with encoder(ByteLevelEncoder, path) as enc:
            rows: list[tuple] = []
            group: list[tuple] = []  # identifier, start in its document, tokens, their bytes, the document's tokens
            held = 0

            def close():
                nonlocal serial, held
                for window in pack([g[2] for g in group], capacity):
                    at, whole = 0, sum(n for _, _, n in window)
                    for i, begin, n in window:
                        doc_id, start, _, raw, total = group[i]
                        rows.append((doc_id, start + begin, n, zlib.crc32(raw[4 * begin : 4 * (begin + n)]), total, serial, at, whole))
                        at += n
                    serial += 1
                group.clear()
                held = 0

            def table():
                out = pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 8)], names=[x.split()[0] for x in SCHEMA.split(", ")])
                rows.clear()
                return out

            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(x.as_py() for x in batch.column(1)), strict=True):
                    raw = memoryview(np.append(ids, end_id).astype("<u4").tobytes())
                    total = len(ids) + 1
                    start = 0
                    while total - start >= capacity:
                        rows.append((doc_id, start, capacity, zlib.crc32(raw[4 * start : 4 * (start + capacity)]), total, serial, 0, capacity))
                        serial += 1
                        start += capacity
                    if start < total:
                        group.append((doc_id, start, total - start, bytes(raw[4 * start :]), total))
                        held += total - start
                        if held >= GROUP * capacity:
                            close()
                    if len(rows) > 20_000:
                        yield table()
            close()
            yield table()

    return frugal(task)


def packed(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    ``vocabulary`` is the path of a byte-level tokenizer file on every worker.  Each id of each
    document, and the end id after it, lies in exactly one piece.  A null or empty text is the end id alone.
    Rows are packed one by one: repeated rows and identifiers and null identifiers each keep their pieces.
    An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_task(vocabulary, capacity, end_id), SCHEMA)
