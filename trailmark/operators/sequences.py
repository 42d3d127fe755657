"""Ordered sequences: displacement, tangents, contiguity, offsets, resampling and smoothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(group: str, order: str):
    return Window.partitionBy(group).orderBy(order)


def displacement(frames: DataFrame, stride: int, group: str = "ep", order: str = "frame") -> DataFrame:
    """dx, dz to the frame ``stride`` later; frames without one are left out."""
    w = ordered(group, order)
    moved = frames.withColumns({"dx": F.lead("x", stride).over(w) - F.col("x"), "dz": F.lead("z", stride).over(w) - F.col("z")})
    return moved.where("dx is not null")


def summary(values: DataFrame, column: str, *by: str) -> DataFrame:
    """Count, mean, population deviation, extremes, quantiles and shares of signs."""
    c = F.col(column)
    q = F.percentile(c, F.array(*[F.lit(x) for x in (0.01, 0.1, 0.5, 0.9, 0.99)]))
    out = values.groupBy(*by).agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.min(c).alias("least"), q.alias("q"), F.max(c).alias("greatest"), F.avg((c > 1e-6).cast("double")).alias("positive"), F.avg((c < -1e-6).cast("double")).alias("negative"))
    return out.select(*by, "n", "mean", "std", "least", *[F.col("q")[k].alias(f"q{s}") for k, s in enumerate(("01", "10", "50", "90", "99"))], "greatest", "positive", "negative")


def gaps(frames: DataFrame, group: str, index: str) -> DataFrame:
    """Per group: first, last, n and whether the index runs without gaps or repeats."""
    return frames.groupBy(group).agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n"), F.countDistinct(index).alias("d")).select(group, "first", "last", "n", ((F.col("last") - F.col("first") + 1 == F.col("n")) & (F.col("d") == F.col("n"))).alias("contiguous"))


#: Rows of a range, and ranges, of a global order.
RANGE_ROWS, MAX_RANGES = 200_000, 4096


def ranged(rows: DataFrame, order: str, part: str = "__part", range_rows: int | None = None) -> DataFrame:
    """rows with the number of their range of a global order: ranges of about RANGE_ROWS rows, nulls in the first.

    The ranges' bounds are read once, so however often the result is evaluated, and with whichever columns, a row is in the same range.
    """
    keys = rows.select(order)
    ranges = max(1, min(MAX_RANGES, -(-keys.count() // (range_rows or RANGE_ROWS))))
    if ranges == 1:
        return rows.withColumn(part, F.lit(0))
    least = keys.where(F.col(order).isNotNull()).repartitionByRange(ranges, order).groupBy(F.spark_partition_id()).agg(F.min(order).alias("b")).select("b")
    bounds = sorted(r.b for r in least.collect())[1:]  # one for each range
    side = max(1, round(len(bounds) ** 0.5))
    blocks = [bounds[i : i + side] for i in range(0, len(bounds), side)]
    heads = F.array(*[F.lit(b[0]) for b in blocks]) if blocks else None
    if heads is None:
        return rows.withColumn(part, F.lit(0))
    key = F.col(order)
    before = lambda values: F.size(F.filter(values, lambda b: b <= key))
    block = before(heads)
    inside = F.element_at(F.array(*[F.array(*[F.lit(b) for b in x]) for x in blocks]), F.greatest(block, F.lit(1)))
    return rows.withColumn(part, F.when(key.isNull() | (block == 0), 0).otherwise((block - 1) * side + before(inside)))


def offsets(sizes: DataFrame, order: str, n: str) -> DataFrame:
    """Global start of each group: the sum of the sizes before it.

    Scales by ranges of the order: sums within a range, and a prefix sum over as many rows as ranges. The order should be unique; nulls come first.
    """
    part = ranged(sizes, order)
    own = Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = part.withColumn("__before", F.sum(n).over(own) - F.col(n))
    totals = part.groupBy("__part").agg(F.sum(n).alias("__n"))
    base = totals.withColumn("__base", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).select("__part", "__base")
    return inside.join(F.broadcast(base), "__part").withColumn("start", F.col("__base") + F.col("__before")).drop("__part", "__before", "__base")


def densify(points: DataFrame, rate: float, group: str = "ep", order: str = "frame") -> DataFrame:
    """Each segment in ceil(length * rate) steps, one at least; the first point starts the line."""
    w = ordered(group, order)
    seg = points.select(group, order, "x", "z", F.lag("x").over(w).alias("px"), F.lag("z").over(w).alias("pz"))
    length = F.sqrt((F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("z") - F.col("pz")) * (F.col("z") - F.col("pz")))
    steps = F.when(F.col("px").isNull(), 1).otherwise(F.greatest(F.lit(1), F.ceil(length * F.lit(rate)))).cast("int")
    out = seg.withColumn("steps", steps).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("steps"))))
    t = F.col("k") / F.col("steps")
    mix = lambda a, b: F.coalesce(F.col(a) + (F.col(b) - F.col(a)) * t, F.col(b))
    return out.select(group, order, "k", mix("px", "x").alias("x"), mix("pz", "z").alias("z"))


def chaikin(points: DataFrame, group: str = "ep", order: str = "frame") -> DataFrame:
    """One round of corner cutting; both ends stay."""
    w = ordered(group, order)
    seg = points.select(group, order, "x", "z", F.lead("x").over(w).alias("nx"), F.lead("z").over(w).alias("nz"), F.row_number().over(w).alias("rn"))
    cut = lambda a, b, s: F.col(a) * (1 - s) + F.col(b) * s
    pt = lambda side, x, z: F.struct(F.lit(side).alias("side"), x.alias("x"), z.alias("z"))
    inner = F.array(pt(1, cut("x", "nx", 0.25), cut("z", "nz", 0.25)), pt(2, cut("x", "nx", 0.75), cut("z", "nz", 0.75)))
    first = F.array(pt(0, F.col("x"), F.col("z")))
    last = F.array(pt(0, F.col("x"), F.col("z")))
    rows = F.when(F.col("nx").isNull(), last).when(F.col("rn") == 1, F.concat(first, inner)).otherwise(inner)
    return seg.select(group, order, F.explode(rows).alias("p")).select(group, (F.col(order) * 3 + F.col("p.side")).alias(order), "p.x", "p.z")


def tangents(points: DataFrame, group: str = "ep", order: str = "frame") -> DataFrame:
    """Unit vector from the last point before that differs to the next that differs, one-sided at the ends; null where all points are the same."""
    w = ordered(group, order)
    fresh = F.when((F.col("x") == F.lag("x").over(w)) & (F.col("z") == F.lag("z").over(w)), 0).otherwise(1)
    run = points.withColumn("__fresh", fresh).withColumn("__run", F.sum("__fresh").over(w))
    heads = run.where("__fresh = 1")
    v = Window.partitionBy(group).orderBy("__run")
    heads = heads.select(group, "__run", *[(F.coalesce(F.lead(c).over(v), F.col(c)) - F.coalesce(F.lag(c).over(v), F.col(c))).alias(f"d{c}") for c in ("x", "z")])
    norm = F.nullif(F.sqrt(F.col("dx") * F.col("dx") + F.col("dz") * F.col("dz")), F.lit(0.0))
    return run.join(heads, [group, "__run"]).select(group, order, "x", "z", (F.col("dx") / norm).alias("fx"), (F.col("dz") / norm).alias("fz"))


def running_clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def smoothed(frames: DataFrame, value: str, keep: float = 0.35, group: str = "ep", order: str = "frame") -> DataFrame:
    """Exponential smoothing from zero, in order: v = keep * v + (1 - keep) * value."""
    rows = frames.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("rows"))
    last = F.aggregate("rows", F.lit(0.0), lambda v, r: v * keep + r[value] * (1 - keep))
    return rows.select(group, F.size("rows").cast("bigint").alias("n"), last.alias("smoothed"))


def motion_cosines(poses: DataFrame, group: str = "ep", order: str = "frame") -> DataFrame:
    """group, order, dot: cosine between the heading and the step to the next frame; steps of no length are left out."""
    d2 = F.col("dx") * F.col("dx") + F.col("dz") * F.col("dz")
    return displacement(poses, 1, group, order).where(d2 > 1e-18).select(group, order, ((F.col("fx") * F.col("dx") + F.col("fz") * F.col("dz")) / F.sqrt(d2)).alias("dot"))


def geometry_hash(points: DataFrame, group: str = "ep", order: str = "frame") -> DataFrame:
    """group, h: SHA-256 of each ordered line's coordinates in units of 1e-8."""
    unit = lambda a: F.round(F.col(a) * F.lit(1e8)).cast("bigint").cast("string")
    rows = points.select(group, F.struct(F.col(order), F.concat_ws(",", unit("x"), unit("z")).alias("p")).alias("q"))
    listed = rows.groupBy(group).agg(F.array_sort(F.collect_list("q")).alias("qs"))
    return listed.select(group, F.sha2(F.array_join(F.transform("qs", lambda q: q["p"]), ";"), 256).alias("h"))


def sampled_depths(depths: DataFrame, count: int, seed: int) -> DataFrame:
    """frame, least, greatest of ``count`` frames drawn without replacement: those that come first in the seeded order."""
    frames = seeded_pick(depths.select("frame").distinct(), "frame", count, seed)
    return depths.join(F.broadcast(frames), "frame").groupBy("frame").agg(F.min("metres").alias("least"), F.max("metres").alias("greatest"))


def covered(ranges: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """One row: whether closed ranges cover 0..n without gap or overlap, and n.

    No global order: without gaps, starts other than 0 are ends + 1, each once.
    """
    starts = ranges.select(F.col(first).alias("at"), F.lit(1).alias("s"), F.lit(0).alias("e"))
    ends = ranges.select((F.col(last) + 1).alias("at"), F.lit(0).alias("s"), F.lit(1).alias("e"))
    edges = starts.unionByName(ends).groupBy("at").agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    lone = edges.agg(F.count_if((F.col("s") > 1) | (F.col("e") > 1) | ((F.col("s") != F.col("e")) & (F.col("at") != 0) & (F.col("e") == 0))).alias("bad"), F.count_if((F.col("s") == 0) & (F.col("e") > 0)).alias("tops"), F.max("at").alias("n"), F.min("at").alias("least"))
    wrong = ranges.agg(F.count_if(F.col(last) < F.col(first)).alias("turned"))
    return lone.crossJoin(wrong).select(((F.col("bad") == 0) & (F.col("tops") == 1) & (F.col("least") == 0) & (F.col("turned") == 0)).alias("covered"), "n")


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """key and the least order of each key; partial aggregates, no sort."""
    return rows.groupBy(key).agg(F.min(order).alias(order))


def ordinals(rows: DataFrame, order: str) -> DataFrame:
    """Rows with their global position (ordinal) by a unique key; sorted by ranges, with a prefix sum over as many rows as ranges."""
    one = rows.withColumn("__one", F.lit(1).cast("bigint"))
    return offsets(one, order, "__one").withColumnRenamed("start", "ordinal").withColumn("ordinal", F.col("ordinal").cast("bigint")).drop("__one")


def evenly_spaced(rows: DataFrame, order: str, count: int) -> DataFrame:
    """Rows at ``count`` evenly spaced positions k from the first to the last."""
    at = rows.sparkSession.range(count).withColumnRenamed("id", "t")
    size = rows.agg(F.count("*").alias("n"))
    step = F.floor(F.col("t") * (F.col("n") - 1) / F.lit(float(max(1, count - 1)))).cast("bigint")
    wanted = at.crossJoin(F.broadcast(size)).where("n > 0").select(step.alias("k")).distinct()
    return ordinals(rows, order).withColumnRenamed("ordinal", "k").join(F.broadcast(wanted), "k", "left_semi")


def seeded_order(seed: int, key: str) -> Column:
    """A text to sort by: fixed by the seed and the key's text, so any engine with MD5 draws the same rows."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def seeded_pick(rows: DataFrame, key: str, count: int, seed: int, *ties: str) -> DataFrame:
    """``count`` rows without replacement, the same for the same seed however the rows are partitioned."""
    return rows.orderBy(seeded_order(seed, key), *(ties or (key,))).limit(count)


def drawn(text: Column, below: Column) -> Column:
    """A whole number from 0 to below - 1, fixed by a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % below


def nested_draws(sizes: DataFrame, group: str, n: str, seed: int) -> DataFrame:
    """group, start, goal: a start in 0..n - 1, and a goal from it on that depends on the start drawn; no group waits for another."""
    name = F.concat(F.lit(f"{seed}:"), F.col(group).cast("string"))
    first = sizes.select(group, n, drawn(name, F.col(n)).alias("start"))
    again = F.concat(name, F.lit(":"), F.col("start").cast("string"))
    return first.select(group, "start", (F.col("start") + drawn(again, F.col(n) - F.col("start"))).alias("goal"))


def chaikin_rounds(points: DataFrame, rounds: int, group: str = "ep", order: str = "frame") -> DataFrame:
    """Corner cutting, round after round, with the points numbered anew; lines of two points or fewer stay."""
    w = Window.partitionBy(group)
    sized = points.withColumn("__n", F.count("*").over(w))
    short, out = sized.where("__n <= 2").drop("__n"), sized.where("__n > 2").drop("__n")
    for _ in range(rounds):
        out = chaikin(out, group, order)
    both = out.unionByName(short.select(*out.columns))
    return both.withColumn(order, (F.row_number().over(ordered(group, order)) - 1).cast("bigint"))
