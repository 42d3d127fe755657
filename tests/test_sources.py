"""Binary sources: round trips, refused files, and parts of records."""

import struct

import numpy as np
import pytest

from trailmark import sources
from trailmark.sources import binary, las, ply


def write_las(path, points, fmt=2, version=(1, 2), declared=None):
    length = {0: 20, 2: 26, 3: 34}[fmt]
    size = 375 if version == (1, 4) else 227
    head = bytearray(size)
    head[:4] = b"LASF"
    head[24], head[25] = version
    struct.pack_into("<HI", head, 94, size, size)
    struct.pack_into("<BH", head, 104, fmt, length)
    struct.pack_into("<I", head, 107, 0 if version == (1, 4) else len(points))
    struct.pack_into("<6d", head, 131, 0.01, 0.1, 0.05, 1.0, 2.0, 3.0)
    if version == (1, 4):
        struct.pack_into("<Q", head, 247, declared or len(points))
    with open(path, "wb") as f:
        f.write(head)
        for k, p in enumerate(points):
            raw = bytearray(length)
            struct.pack_into("<3iHBB", raw, 0, *p, k % 60000, 0b00010001 | (k % 2) << 1, k % 32)
            if fmt == 3:
                struct.pack_into("<d", raw, 20, k / 4)
            if fmt in (2, 3):
                struct.pack_into("<3H", raw, {2: 20, 3: 28}[fmt], k, k + 1, k + 2)
            f.write(raw)


@pytest.mark.parametrize("fmt,version", [(0, (1, 2)), (2, (1, 2)), (3, (1, 2)), (3, (1, 4))])
def test_las(spark, tmp_path, monkeypatch, fmt, version):
    sources.register(spark)
    points = [(k, -k, 2 * k) for k in range(200)]
    path = str(tmp_path / "a.las")
    write_las(path, points, fmt, version)
    got = spark.read.format("las").load(path).orderBy("pos").collect()
    assert [g["pos"] for g in got] == list(range(200))
    assert np.allclose([(g.x, g.y, g.z) for g in got], [(k * 0.01 + 1, -k * 0.1 + 2, k * 0.1 + 3) for k in range(200)])
    assert {(g.return_number, g.number_of_returns) for g in got} == {(1, 2), (3, 2)}
    assert [g.classification for g in got] == [k % 32 for k in range(200)]
    assert got[7].red == (None if fmt == 0 else 7) and got[7].gps_time == (7 / 4 if fmt == 3 else None)


def test_las_parts_and_faults(tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "PART", 64)
    path = str(tmp_path / "a.las")
    write_las(path, [(k, 0, 0) for k in range(200)])
    parts = las._Reader(path).partitions()
    assert [(p.value.first, p.value.last) for p in parts] == [(0, 64), (64, 128), (128, 192), (192, 200)]
    with open(path, "r+b") as f:
        f.truncate(227 + 26 * 150)
    with pytest.raises(ValueError):
        for p in parts:
            list(las._Reader(path).read(p))
    with open(path, "r+b") as f:
        f.seek(104)
        f.write(bytes([2 | 0x80]))
    with pytest.raises(ValueError):
        las.header(path)


def test_ply(spark, tmp_path):
    sources.register(spark)
    path = str(tmp_path / "a.ply")
    rows = spark.range(300).selectExpr("id as __k", "cast(id as float) as x", "cast(-id as float) as y", "cast(id / 2 as double) as z", "cast(id % 256 as int) as red", "cast(0 as int) as green", "cast(9 as int) as blue")
    ply.write_ply(rows, path, ["__k"])
    got = spark.read.format("ply").load(path).orderBy("pos").collect()
    assert [(g.pos, g.x, g.y, g.z, g.red, g.blue) for g in got] == [(k, k, -k, k / 2, k % 256, 9) for k in range(300)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.ply"]


@pytest.mark.parametrize("text", ["ply\nformat binary_big_endian 1.0\nelement vertex 1\nproperty float x\nend_header\n", "ply\nformat binary_little_endian 1.0\nelement vertex 1\nproperty list uchar int x\nend_header\n", "nothing"])
def test_refused_ply(tmp_path, text):
    path = tmp_path / "b.ply"
    path.write_text(text)
    with pytest.raises(ValueError):
        ply.header(str(path))
