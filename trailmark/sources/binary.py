"""Fixed-size binary records in byte ranges: what the file sources share."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs

#: Records read together, and records of one partition.
BATCH, PART = 1 << 17, 1 << 22


def opened(path: str):
    """A seekable file at a path or URI of any file system that Arrow knows."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(path)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


@dataclass
class Span:
    """Records first to last of the data that starts at an offset of a file."""

    path: str
    offset: int
    first: int
    last: int


def spans(path: str, offset: int, count: int) -> list[Span]:
    return [Span(path, offset, a, min(a + PART, count)) for a in range(0, count, PART)] or [Span(path, offset, 0, 0)]


def batches(span: Span, record: np.dtype, columns):
    """Arrow batches of columns(records, their positions); a file that ends early raises."""
    with opened(span.path) as f:
        for at in range(span.first, span.last, BATCH):
            n = min(BATCH, span.last - at)
            f.seek(span.offset + at * record.itemsize)
            raw = f.read(n * record.itemsize)
            if len(raw) < n * record.itemsize:
                raise ValueError(f"{span.path} ends before record {at + n}")
            arrays = columns(np.frombuffer(raw, record), np.arange(at, at + n, dtype=np.int64))
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in arrays.items()})
