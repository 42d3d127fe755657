"""Vertices of binary little-endian PLY files: ``spark.read.format("ply")`` and an ordered writer."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import binary

# Fixed values of the format: scalar types.
TYPES = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "<i2", "int16": "<i2", "ushort": "<u2", "uint16": "<u2", "int": "<i4", "int32": "<i4", "uint": "<u4", "uint32": "<u4", "float": "<f4", "float32": "<f4", "double": "<f8", "float64": "<f8"}
_SPARK = {"i1": "int", "u1": "int", "<i2": "int", "<u2": "int", "<i4": "int", "<u4": "bigint", "<f4": "float", "<f8": "double"}
_ARROW = {"int": np.int32, "bigint": np.int64, "float": np.float32, "double": np.float64}
_WRITE = {"tinyint": "char", "smallint": "short", "int": "int", "float": "float", "double": "double"}


def header(path: str) -> tuple[list[tuple[str, str]], int, int]:
    """(name, numpy type) of the vertex fields, vertices, and where their data starts.  Lists and other byte orders are refused."""
    with binary.opened(path) as f:
        raw = f.read(1 << 16)
    end = raw.find(b"end_header")
    if not raw.startswith(b"ply") or end < 0:
        raise ValueError(f"{path} isn't a PLY file")
    start = raw.index(b"\n", end) + 1
    fields, count, element = [], None, None
    for line in raw[:end].decode("ascii").splitlines():
        word = line.split()
        if word[:1] == ["format"] and word[1] != "binary_little_endian":
            raise ValueError(f"{path}: {word[1]} isn't read")
        if word[:1] == ["element"]:
            if count is None and word[1] != "vertex":
                raise ValueError(f"{path}: vertices aren't the first element")
            element = word[1]
            count = int(word[2]) if element == "vertex" else count
        if word[:1] == ["property"] and element == "vertex":
            if word[1] == "list" or word[1] not in TYPES:
                raise ValueError(f"{path}: property {line!r} isn't read")
            fields.append((word[2], TYPES[word[1]]))
    if count is None:
        raise ValueError(f"{path} has no vertices")
    return fields, count, start


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.fields, self.count, self.start = header(path)

    def partitions(self):
        return [InputPartition(s) for s in binary.spans(self.path, self.start, self.count)]

    def read(self, partition):
        def columns(p, pos):
            return {"pos": pos} | {n: p[n].astype(_ARROW[_SPARK[t]]) for n, t in self.fields}

        yield from binary.batches(partition.value, np.dtype(self.fields), columns)


class PlySource(DataSource):
    """Columns: pos (the vertex's number) and the file's own."""

    @classmethod
    def name(cls):
        return "ply"

    def schema(self):
        return "pos long, " + ", ".join(f"`{n}` {_SPARK[t]}" for n, t in header(self.options["path"])[0])

    def reader(self, schema):
        return _Reader(self.options["path"])


def write_ply(rows: DataFrame, path: str, order: list[str], bytes_for: tuple[str, ...] = ("red", "green", "blue")) -> None:
    """One file on the driver's file system, in the given order, without the order's own columns that start with "__".

    Partitions arrive one after another, so the driver holds one at a time; the file gets its name when it is whole.
    """
    kept = [(f.name, "uchar" if f.name in bytes_for else _WRITE[f.dataType.simpleString()]) for f in rows.schema if not f.name.startswith("__")]
    layout = np.dtype([(n, TYPES[t]) for n, t in kept])
    ordered = rows.orderBy(*order)
    held, count = f"{path}.part", 0
    data = f"{path}.data"
    with open(data, "wb") as out:
        buffer: list[tuple] = []
        for row in ordered.select(*[n for n, _ in kept]).toLocalIterator():
            buffer.append(tuple(row))
            if len(buffer) == binary.BATCH:
                out.write(np.array(buffer, layout).tobytes())
                count, buffer = count + len(buffer), []
        out.write(np.array(buffer, layout).tobytes())
        count += len(buffer)
    with open(held, "wb") as out, open(data, "rb") as body:
        out.write("".join(["ply\nformat binary_little_endian 1.0\n", f"element vertex {count}\n", *[f"property {t} {n}\n" for n, t in kept], "end_header\n"]).encode("ascii"))
        while chunk := body.read(1 << 22):
            out.write(chunk)
    os.remove(data)
    os.replace(held, path)
