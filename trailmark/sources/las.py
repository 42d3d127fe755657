"""Uncompressed LAS point clouds as a Spark source: ``spark.read.format("las")``.

Parts of a file are ranges of records, so one large file is read by many tasks.  Columns: pos (the
record's number), x, y, z (scaled), intensity, return_number, number_of_returns, classification,
gps_time, red, green, blue; a column that the point format doesn't have is null.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import binary

# Fixed values of the format: offsets of header fields.
_VERSION, _SIZE, _DATA, _FORMAT, _LENGTH, _COUNT, _SCALE, _BOUNDS, _LONG_COUNT = 24, 94, 96, 104, 105, 107, 131, 179, 247
# Offsets in a point record of the time and of the colour, by point format.
_TIME = {1: 20, 3: 20, 4: 20, 5: 20, 6: 22, 7: 22, 8: 22, 9: 22, 10: 22}
_COLOUR = {2: 20, 3: 28, 5: 28, 7: 30, 8: 30, 10: 30}

SCHEMA = "pos long, x double, y double, z double, intensity int, return_number int, number_of_returns int, classification int, gps_time double, red int, green int, blue int"


def header(path: str) -> dict:
    """Version, point format, record length, count, scale, offset and bounds; compressed files are refused."""
    with binary.opened(path) as f:
        raw = f.read(375)
    if raw[:4] != b"LASF" or len(raw) < 227:
        raise ValueError(f"{path} isn't a LAS file")
    if raw[_FORMAT] & 0x80:
        raise ValueError(f"{path} is compressed")
    get = lambda fmt, at: struct.unpack_from("<" + fmt, raw, at)
    version = (raw[_VERSION], raw[_VERSION + 1])
    count = get("I", _COUNT)[0]
    if version >= (1, 4) and get("H", _SIZE)[0] >= 375:
        count = get("Q", _LONG_COUNT)[0] or count
    hi_lo = get("6d", _BOUNDS)
    return {"version": version, "format": raw[_FORMAT], "length": get("H", _LENGTH)[0], "data": get("I", _DATA)[0], "count": count, "scale": get("3d", _SCALE), "offset": get("3d", _SCALE + 24), "greatest": hi_lo[0::2], "least": hi_lo[1::2]}


def record(head: dict) -> np.dtype:
    """Fields of a point record that columns are made of."""
    new = head["format"] >= 6
    fields = {"X": ("<i4", 0), "Y": ("<i4", 4), "Z": ("<i4", 8), "intensity": ("<u2", 12), "flags": ("u1", 14), "class": ("u1", 16 if new else 15)}
    if head["format"] in _TIME:
        fields["time"] = ("<f8", _TIME[head["format"]])
    if head["format"] in _COLOUR:
        fields |= {k: ("<u2", _COLOUR[head["format"]] + 2 * i) for i, k in enumerate(("red", "green", "blue"))}
    return np.dtype({"names": list(fields), "formats": [v[0] for v in fields.values()], "offsets": [v[1] for v in fields.values()], "itemsize": head["length"]})


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.head = header(path)

    def partitions(self):
        return [InputPartition(s) for s in binary.spans(self.path, self.head["data"], self.head["count"])]

    def read(self, partition):
        head = self.head
        new = head["format"] >= 6

        def columns(p, pos):
            out = {"pos": pos}
            for k, axis in enumerate("XYZ"):
                out[axis.lower()] = p[axis] * head["scale"][k] + head["offset"][k]
            out["intensity"] = p["intensity"].astype(np.int32)
            out["return_number"] = (p["flags"] & (15 if new else 7)).astype(np.int32)
            out["number_of_returns"] = ((p["flags"] >> (4 if new else 3)) & (15 if new else 7)).astype(np.int32)
            out["classification"] = (p["class"] & (255 if new else 31)).astype(np.int32)
            out["gps_time"] = p["time"].astype(np.float64) if "time" in p.dtype.names else np.ma.masked_all(len(p), np.float64)
            for k in ("red", "green", "blue"):
                out[k] = p[k].astype(np.int32) if k in p.dtype.names else np.ma.masked_all(len(p), np.int32)
            return out

        yield from binary.batches(partition.value, record(head), columns)


class LasSource(DataSource):
    @classmethod
    def name(cls):
        return "las"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])
