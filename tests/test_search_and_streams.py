"""Routes against relaxation by brute force, lines against stepping, streams against their batch form."""

import numpy as np
from pyspark.sql import functions as F

from trailmark.operators import cells, search
from trailmark.operators.sequences import covered
from trailmark.streaming import topics


def test_routes_cost_least(spark):
    rng = np.random.default_rng(5)
    solid = rng.random((9, 12)) < 0.25
    extra = rng.random((9, 12))
    free = [(i, j) for j in range(9) for i in range(12) if not solid[j, i]]
    tasks = [(k, *free[rng.integers(len(free))], *free[rng.integers(3)]) for k in range(40)] + [(99, -1, 0, 1, 1)]
    got = {r["id"]: r for r in search.routes(spark.createDataFrame(tasks, "id long, i0 long, j0 long, i1 long, j1 long"), solid, extra).collect()}
    assert len(got) == len(tasks) and got[99]["cost"] is None
    for k, i0, j0, i1, j1 in tasks[:-1]:
        best = {(i0, j0): 0.0}
        for _ in range(len(free)):
            for (i, j), at in list(best.items()):
                for a, b, length in search._STEPS:
                    n = (i + a, j + b)
                    if n in free:
                        best[n] = min(best.get(n, np.inf), at + length + extra[n[1], n[0]])
        want = best.get((i1, j1))
        assert (got[k]["cost"] is None) == (want is None)
        if want is not None:
            assert abs(got[k]["cost"] - want) < 1e-9
            route = [(c["i"], c["j"]) for c in got[k]["cells"]]
            assert route[0] == (i0, j0) and route[-1] == (i1, j1) and set(route) <= set(free)


def test_line_cells(spark):
    rng = np.random.default_rng(1)
    ends = [tuple(map(int, rng.integers(0, 15, 4))) for _ in range(80)]
    got = cells.line_cells(spark.createDataFrame([(k, *e) for k, e in enumerate(ends)], "id long, i0 long, j0 long, i1 long, j1 long")).collect()
    for k, (i0, j0, i1, j1) in enumerate(ends):
        n = max(abs(i1 - i0), abs(j1 - j0))
        halves_back = lambda a, b, t: a + (1 if b > a else -1) * ((2 * abs(b - a) * t + n - 1) // (2 * n)) if n else a
        want = [(halves_back(i0, i1, t), halves_back(j0, j1, t)) for t in range(n + 1)]
        line = [(r["i"], r["j"]) for r in sorted((r for r in got if r["id"] == k), key=lambda r: r["k"])]
        assert line == want and line[0] == (i0, j0) and line[-1] == (i1, j1)


def test_cover(spark):
    ok = lambda *r: covered(spark.createDataFrame(list(r), "first long, last long")).first()["covered"]
    assert ok((0, 3), (4, 4), (5, 9))
    assert not ok((0, 3), (5, 9)) and not ok((0, 3), (3, 9)) and not ok((1, 3)) and not ok((0, 3), (0, 3)) and not ok((0, 9), (5, 4))


def test_streams_match_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run(frame, name, mode):
        q = frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    got = run(topics.latest(stream, "event_type", "value", "ts", "event_id"), "latest", "complete")
    assert sorted(got.collect()) == sorted(topics.latest(events, "event_type", "value", "ts", "event_id").collect())
    n = run(topics.windowed(stream, "ts", "1 hour", "365 days", "event_type"), "hours", "update")
    last = n.groupBy("window", "event_type").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
    assert last == events.count()
    smooth = run(topics.smoothed(stream, "event_type", "event_id", "value"), "smooth", "update")
    assert smooth.agg(F.sum("n")).first()[0] == events.count() and smooth.where("smoothed between 0 and 500").count() == smooth.count()
