"""Publishing, listings, settings and seeded draws against plain counterparts."""

import dataclasses
import hashlib
import random

import pytest

from trailmark.operators import sequences as S
from trailmark.sources import folders, settings


def test_publish_keeps_or_replaces(spark, tmp_path):
    target = str(tmp_path / "set")
    write = lambda n: lambda path: spark.range(n).write.parquet(path)
    folders.publish(spark, target, write(3), lambda path: None)
    with pytest.raises(FileExistsError):
        folders.publish(spark, target, write(4), lambda path: None)

    def fails(path):
        raise ValueError("bad")

    with pytest.raises(ValueError):
        folders.publish(spark, target, write(4), fails, overwrite=True)
    assert spark.read.parquet(target).count() == 3
    folders.publish(spark, target, write(5), lambda path: None, overwrite=True)
    assert spark.read.parquet(target).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["set"]


def test_listing_and_lines(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, 'a"b,\n'), (2, "x", "")], "k int, v string, t string")
    folders.write_lines(rows, str(tmp_path / "lines"))
    text = "".join(p.read_text() for p in (tmp_path / "lines").glob("part-*"))
    assert sorted(text.splitlines()) == ['{"k":1,"v":null,"t":"a\\"b,\\n"}', '{"k":2,"v":"x","t":""}']
    got = folders.usage(folders.listing(spark, str(tmp_path), "*.json")).first()
    assert got["bytes"] == len(text) and got["files"] >= 1
    (tmp_path / "none").mkdir()
    assert tuple(folders.usage(folders.listing(spark, str(tmp_path / "none"))).first()) == (0, 0)
    with pytest.raises(ValueError, match="a, b"):
        folders.required(rows, ["a", "k", "b"])
    with pytest.raises(Exception, match="2 x 2"):
        folders.matrices(spark.sql("SELECT array(1.0D, 2.0D) AS m"), {"m": (2, 2)}).collect()


@dataclasses.dataclass
class Camera:
    width: int
    near: float = 0.1


def test_sections():
    assert settings.sections("[camera]\nwidth = 3", {"camera": Camera}) == {"camera": Camera(3)}
    for text in ("", "[camera]\nnear = 1.0", "[camera]\nwidth = 3\nfar = 2", "[camera]\nwidth = 3\n[lens]", "camera = 3"):
        with pytest.raises(ValueError):
            settings.sections(text, {"camera": Camera})
    assert settings.path_below("/a/", "b") == "/a/b" and settings.path_below("/a", "/c") == "/c"
    with pytest.raises(ValueError):
        settings.path_below("/a", " ")


def test_regions():
    rng = random.Random(3)
    for _ in range(200):
        region = settings.Region(rng.random() + 0.01, (rng.uniform(-9, 9), -0.0), tuple((rng.uniform(-1e6, 1e6), rng.random() * 1e-7) for _ in range(rng.randint(3, 9))))
        assert settings.load_region(settings.dump_region(region)) == region
    flow = "# region\nresolution: 0.1\norigin: [0, -1.5]  # corner\npolygon: [[0, 0], [2, 0], [2, 2]]\n"
    assert settings.load_region(flow).polygon == ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0))
    for text in ("", flow + "more: 1\n", flow + "origin: [1, 2]\n", flow.replace("0.1", "-1"), flow.replace("0.1", ".inf"), flow.replace("[2, 2]", "[4, 0]"), flow.replace("[2, 2]", "[2]"), flow.replace("[2, 2]", "[2, true]"), flow.replace("]]", "]"), "- 1\n"):
        with pytest.raises(ValueError):
            settings.load_region(text)


def test_draws(spark):
    sizes = spark.createDataFrame([(k, k % 5 + 1) for k in range(300)], "ep long, n long")
    for row in S.nested_draws(sizes, "ep", "n", 11).collect():
        first, n = int(hashlib.md5(f"11:{row.ep}".encode()).hexdigest()[:8], 16), row.ep % 5 + 1
        again = int(hashlib.md5(f"11:{row.ep}:{first % n}".encode()).hexdigest()[:8], 16)
        assert (row.start, row.goal) == (first % n, first % n + again % (n - first % n)) and row.goal < n


def test_chaikin_rounds(spark):
    rng = random.Random(5)
    lines = {ep: [(rng.random(), rng.random()) for _ in range(n)] for ep, n in enumerate([1, 2, 3, 4, 9, 30])}
    rows = spark.createDataFrame([(ep, k, x, z) for ep, line in lines.items() for k, (x, z) in enumerate(line)], "ep long, frame long, x double, z double")
    got = {ep: [] for ep in lines}
    for p in S.chaikin_rounds(rows, 2).orderBy("ep", "frame").collect():
        assert p.frame == len(got[p.ep])
        got[p.ep].append((p.x, p.z))
    for ep, line in lines.items():
        for _ in range(2 if len(line) > 2 else 0):
            cut = [line[0]]
            for (a, b), (u, v) in zip(line, line[1:]):
                cut += [(a * 0.75 + u * 0.25, b * 0.75 + v * 0.25), (a * 0.25 + u * 0.75, b * 0.25 + v * 0.75)]
            line = [*cut, line[-1]]
        assert len(got[ep]) == len(line)
        assert all(abs(p - q) < 1e-12 for a, b in zip(got[ep], line) for p, q in zip(a, b))
