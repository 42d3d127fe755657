"""Joins by hash, range and distance, and duplicate exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import widened
from .sequences import ordinals

#: Cell tables below this many rows may be broadcast.
BROADCAST_ROWS = 1_000_000


def classified(points: DataFrame, cells: DataFrame) -> DataFrame:
    """points (i, j, ...) with ``hit``: whether their cell is in cells. Cells are broadcast only after a count; else both are shuffled."""
    cells = cells.select("i", "j").distinct().withColumn("hit", F.lit(True))
    small = cells.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return points.join(F.broadcast(cells) if small else cells, ["i", "j"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def first_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    best = rows.groupBy(key).agg(F.min(order).alias(order))
    return rows.join(best, [key, order], "left_semi")


def excluding(candidates: DataFrame, history: DataFrame, key: str, order: str) -> DataFrame:
    """First occurrences among candidates whose key the history doesn't have."""
    return first_of_each(candidates.join(history.select(key).distinct(), key, "left_anti"), key, order)


def matches(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """All pairs of equal keys."""
    return left.select(key, F.col(left_id).alias("left_id")).join(right.select(key, F.col(right_id).alias("right_id")), key)


def in_ranges(frames: DataFrame, ranges: DataFrame, index: str, first: str, last: str, width: int) -> DataFrame:
    """Frames with the closed ranges that hold them, as an equi-join on buckets of ``width`` indices."""
    buckets = ranges.withColumn("__b", F.explode(F.sequence(F.expr(f"{first} div {width}"), F.expr(f"{last} div {width}"))))
    return frames.withColumn("__b", F.expr(f"{index} div {width}")).join(buckets, "__b").where(F.col(index).between(F.col(first), F.col(last))).drop("__b")


def within(left: DataFrame, right: DataFrame, distance: float, left_id: str, right_id: str) -> DataFrame:
    """Pairs of points (x, z) at most ``distance`` apart, by cells of that size and their neighbours. Both sides are shuffled: neither need fit in memory."""
    at = lambda c: F.floor(F.col(c) / distance)
    near = F.sequence(F.lit(-1), F.lit(1))
    a = left.select(F.col(left_id).alias("left_id"), F.col("x").alias("ax"), F.col("z").alias("az"), F.explode(F.transform(near, lambda d: at("x") + d)).alias("ci"), at("z").alias("__j")).select("left_id", "ax", "az", "ci", F.explode(F.transform(near, lambda d: F.col("__j") + d)).alias("cj"))
    b = right.select(F.col(right_id).alias("right_id"), F.col("x").alias("bx"), F.col("z").alias("bz"), at("x").alias("ci"), at("z").alias("cj"))
    d2 = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("az") - F.col("bz")) * (F.col("az") - F.col("bz"))
    return a.join(b.hint("merge"), ["ci", "cj"]).withColumn("d2", d2).where(F.col("d2") <= distance * distance).select("left_id", "right_id", "d2")


def least_within(points: DataFrame, distance: float, key: str) -> DataFrame:
    """points (x, z, ...) with ``least``: the smallest key at most ``distance`` away, its own included. Points of one place are compared once."""
    places = points.groupBy("x", "z").agg(F.min(key).alias("least")).withColumn("place", F.struct("x", "z"))
    near = within(places, places, distance, "place", "least").groupBy("left_id").agg(F.min("right_id").alias("least"))
    return points.join(near.select("left_id.x", "left_id.z", "least"), ["x", "z"], "left")


def nearest(left: DataFrame, right: DataFrame) -> DataFrame:
    """left (x, z, ...) with ``d2``, the squared distance to the nearest point of right; no rows where right is empty.

    Points of one place are searched for once, at first within the spacing of right's places, so that a place meets few others.
    """
    place = lambda d: d.select("x", "z").distinct().withColumn("place", F.struct("x", "z"))
    asked, given = place(left), place(right)
    size = given.agg(F.count("*").alias("n"), (F.max("x") - F.min("x")).alias("w"), (F.max("z") - F.min("z")).alias("h")).first()
    once = lambda todo, radius: within(todo, given, radius, "place", "place").groupBy(F.col("left_id").alias("place")).agg(F.min("d2").alias("d2"))
    if size.n:
        near = widened(once, asked, ["place"], max((size.w * size.h / size.n) ** 0.5, max(size.w, size.h) / size.n) or 1.0)[0]
    else:
        near = once(asked, 1.0)
    return left.join(near.select("place.x", "place.z", "d2"), ["x", "z"])


def positional(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows side by side in their orders (n from 0), over a full outer join, so that a length mismatch shows as nulls."""
    number = lambda d, o: ordinals(d, o).withColumnRenamed("ordinal", "n")
    return number(left, left_order).join(number(right, right_order), "n", "full")


def zbuffer(pixels: DataFrame, *value: str) -> DataFrame:
    """Per (u, v) the nearest depth and what lies there; ties take the smallest value."""
    return pixels.groupBy("u", "v").agg(F.min(F.struct("depth", *value)).alias("p")).select("u", "v", "p.*")


def stale(expected: dict[str, Column]) -> Column:
    """Whether any of the named expressions differs from what is expected; nulls are equal to nulls."""
    same = None
    for name, value in expected.items():
        one = F.expr(name).eqNullSafe(value)
        same = one if same is None else same & one
    return ~same


def matched(entries: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """One row: entries, how many have a file, and whether all have one."""
    found = files.select(key).distinct().withColumn("__found", F.lit(1))
    both = entries.select(key).join(found, key, "left").agg(F.count("*").alias("entries"), F.count("__found").alias("matched"))
    return both.withColumn("complete", F.col("entries") == F.col("matched"))


def at_least_or_best(rows: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows whose value reaches the limit; where none does, those with the greatest."""
    best = rows.agg(F.least(F.max(column), F.lit(limit)).alias("__bar"))
    return rows.join(F.broadcast(best), F.col(column) >= F.col("__bar")).drop("__bar")


def stage_status(ids: DataFrame, camera: DataFrame, rendered: DataFrame) -> DataFrame:
    """id and status: rendered needs both stages, camera the first, others are pending."""
    mark = lambda t, name: t.select("id").distinct().withColumn(name, F.lit(True))
    both = ids.join(mark(camera, "camera"), "id", "left").join(mark(rendered, "rendered"), "id", "left")
    return both.select("id", F.when(F.col("rendered") & F.col("camera"), "rendered").when(F.col("camera"), "camera").otherwise("pending").alias("status"))


def agreement(rows: DataFrame, history: DataFrame, exact: str, rounded: str) -> DataFrame:
    """One row: rows that only one of two hashes finds in the history, and all rows."""
    mark = lambda key, name: history.select(F.col(key).alias(f"__{name}")).distinct().withColumn(name, F.lit(True))
    both = rows.join(mark(exact, "by_exact"), F.col(exact) == F.col("__by_exact"), "left").join(mark(rounded, "by_rounded"), F.col(rounded) == F.col("__by_rounded"), "left")
    differ = ~F.col("by_exact").eqNullSafe(F.col("by_rounded"))
    return both.agg(F.count_if(differ).alias("disagreements"), F.count("*").alias("n"))
