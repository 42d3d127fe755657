"""Registered queries: the operators of this package on carrier tables, beside their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import grid, numeric, pose
from ..operators import cells as C
from ..operators import matching as M
from ..operators import sequences as S
from . import carriers as T
from .registry import ORACLES, QUERIES, c, query, r  # noqa: F401

# Projections and scalar mathematics


@query("p01_decode_points", "SELECT l_orderkey, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM points", "points")
def p01(s, d):
    return T.points(s, d).select("l_orderkey", r(c("x")).alias("x"), r(c("y")).alias("y"), r(c("z")).alias("z"))


@query("p03_world_to_cell", "SELECT CAST(floor((x - 1.03::DOUBLE) / 0.08::DOUBLE) AS BIGINT) AS i, CAST(floor((z - 2.01::DOUBLE) / 0.08::DOUBLE) AS BIGINT) AS j, count(*) AS n FROM points GROUP BY ALL", "points")
def p03(s, d):
    return T.points(s, d).groupBy(grid.cell(c("x"), 1.03, 0.08).alias("i"), grid.cell(c("z"), 2.01, 0.08).alias("j")).agg(F.count("*").alias("n"))


@query("p04_cell_centre", "SELECT DISTINCT CAST(floor(x / 0.5::DOUBLE) AS BIGINT) AS i, round((floor(x / 0.5::DOUBLE) + 0.5::DOUBLE) * 0.5::DOUBLE, 6) AS cx FROM points", "points")
def p04(s, d):
    i = grid.cell(c("x"), 0.0, 0.5)
    return T.points(s, d).select(i.alias("i"), r(grid.cell_centre(i, 0.0, 0.5)).alias("cx")).distinct()


@query("p05_grid_spec", "SELECT CAST(ceil((max(x) - min(x)) / 0.08::DOUBLE) AS BIGINT) + 1 AS width, CAST(ceil((max(z) - min(z)) / 0.08::DOUBLE) AS BIGINT) + 1 AS height FROM points", "points")
def p05(s, d):
    size = lambda a: F.ceil((F.max(a) - F.min(a)) / 0.08).cast("bigint") + 1
    return T.points(s, d).agg(size("x").alias("width"), size("z").alias("height"))


@query("p06_bounds_of_corners", "SELECT round(min(x) - 0.5, 6) AS x0, round(max(x) + 0.5, 6) AS x1, round(min(y) - 0.5, 6) AS y0, round(max(y) + 0.5, 6) AS y1, round(min(z) - 0.5, 6) AS z0, round(max(z) + 0.5, 6) AS z1 FROM points", "points")
def p06(s, d):
    return T.points(s, d).agg(*[e for a in "xyz" for e in (r(F.min(a) - 0.5).alias(f"{a}0"), r(F.max(a) + 0.5).alias(f"{a}1"))])


@query("p09_sigmoid", "SELECT id, round(CASE WHEN opacity_logit >= 0 THEN 1 / (1 + exp(-opacity_logit)) ELSE exp(opacity_logit) / (1 + exp(opacity_logit)) END, 9) AS opacity FROM splats", "splats")
def p09(s, d):
    return T.splats(s, d).select("id", r(numeric.sigmoid(c("opacity_logit")), 9).alias("opacity"))


@query("p11_unit_vectors", "SELECT vec_id, list_transform(a[1:3], lambda v: round(v / sqrt(a[1] * a[1] + a[2] * a[2] + a[3] * a[3]), 9)) AS u FROM poses", "poses")
def p11(s, d):
    n = F.sqrt(c("a")[0] * c("a")[0] + c("a")[1] * c("a")[1] + c("a")[2] * c("a")[2])
    return T.poses(s, d).select("vec_id", F.array(*[r(c("a")[k] / F.nullif(n, F.lit(0.0)), 9) for k in range(3)]).alias("u"))


@query("p12_matrix_product", "SELECT vec_id, flatten(list_transform(range(0, 4), lambda i: list_transform(range(0, 4), lambda j: round(a[4 * i + 1] * b[j + 1] + a[4 * i + 2] * b[4 + j + 1] + a[4 * i + 3] * b[8 + j + 1] + a[4 * i + 4] * b[12 + j + 1], 9)))) AS m FROM poses", "poses")
def p12(s, d):
    return T.poses(s, d).select("vec_id", F.transform(pose.matmul(c("a"), c("b")), lambda x: r(x, 9)).alias("m"))


@query("p14_determinant", "SELECT vec_id, round(a[1] * (a[6] * a[11] - a[7] * a[10]) - a[2] * (a[5] * a[11] - a[7] * a[9]) + a[3] * (a[5] * a[10] - a[6] * a[9]), 9) AS det FROM poses", "poses")
def p14(s, d):
    return T.poses(s, d).select("vec_id", r(pose.determinant3(c("a")), 9).alias("det"))


@query("p19_change_of_world", "SELECT vec_id, a[1:4] || list_transform(a[9:12], lambda v: -v) || a[5:8] || a[13:16] AS m FROM poses", "poses")
def p19(s, d):
    return T.poses(s, d).select("vec_id", pose.change_of_world(c("a")).alias("m"))


@query("p21_pinhole_projection", "SELECT l_orderkey, round(CASE WHEN z - 5 > 0 THEN 400 * (x - 10) / (z - 5) + 424 END, 6) AS u, round(CASE WHEN z - 5 > 0 THEN 400 * y / (z - 5) + 240 END, 6) AS v FROM points", "points")
def p21(s, d):
    u, v = pose.project(c("x") - 10, c("y"), c("z") - 5, 400.0, 400.0, 424.0, 240.0)
    return T.points(s, d).select("l_orderkey", r(u).alias("u"), r(v).alias("v"))


@query("p22_unprojection", "SELECT frame, pos, round((pos % 8 - 3.5::DOUBLE) / 10 * metres, 6) AS x, round((pos // 8 - 3.5::DOUBLE) / 10 * metres, 6) AS y, round(metres, 6) AS z FROM depths", "depths")
def p22(s, d):
    x, y, z = pose.unproject(c("pos") % 8, F.expr("pos div 8"), c("metres"), 10.0, 10.0, 3.5, 3.5)
    return T.depths(s, d).select("frame", "pos", r(x).alias("x"), r(y).alias("y"), r(z).alias("z"))


@query("p25_harmonics_by_basis", "SELECT vec_id, flatten(list_transform(range(1, 6), lambda k: [a[k], a[k + 5], a[k + 10]])) AS sh FROM poses", "poses")
def p25(s, d):
    return T.poses(s, d).select("vec_id", F.array(*[c("a")[k + 5 * ch] for k in range(5) for ch in range(3)]).alias("sh"))


@query("p26_colour_from_harmonic", "SELECT vec_id, CAST(round_even(least(1, greatest(0, a[1] * 0.2820948::DOUBLE + 0.5::DOUBLE)) * 255, 0) AS INTEGER) AS red FROM poses", "poses")
def p26(s, d):
    return T.poses(s, d).select("vec_id", numeric.colour_from_dc(c("a")[0]).alias("red"))


_CODE = "CAST(CASE WHEN isfinite(metres) AND metres BETWEEN 0.1 AND 5.0 THEN round_even(metres * 10000.0::DOUBLE, 0) ELSE 0 END AS INTEGER)"


@query("p28_depth_codes", f"SELECT frame, pos, {_CODE} AS code FROM depths", "depths")
def p28(s, d):
    return T.depths(s, d).select("frame", "pos", numeric.depth_code(c("metres")).alias("code"))


@query("p30_depth_recode", f"SELECT frame, pos, CAST(trunc((({_CODE}::FLOAT / 10000::FLOAT)::FLOAT * 10000::FLOAT)::FLOAT) AS INTEGER) AS code FROM depths", "depths")
def p30(s, d):
    return T.depths(s, d).select("frame", "pos", numeric.depth_recode(numeric.depth_code(c("metres"))).alias("code"))


@query("p32_heading", "SELECT ep, frame, round(atan2(x, z + 1), 9) AS heading, round(sqrt(x * x + z * z), 9) AS planar FROM frames", "frames")
def p32(s, d):
    return T.frames(s, d).select("ep", "frame", r(F.atan2(c("x"), c("z") + 1), 9).alias("heading"), r(F.sqrt(c("x") * c("x") + c("z") * c("z")), 9).alias("planar"))


@query("p36_names", "SELECT user_id AS ep, lpad(CAST(user_id AS VARCHAR), 6, '0') AS name, translate(CAST(event_id AS VARCHAR) || '.5-', '-.', 'mp') AS token FROM events")
def p36(s, d):
    e = T.table(s, d, "events")
    return e.select(c("user_id").alias("ep"), F.lpad(c("user_id").cast("string"), 6, "0").alias("name"), F.translate(F.concat(c("event_id").cast("string"), F.lit(".5-")), "-.", "mp").alias("token"))


@query("p37_safe_paths", "SELECT page_id, regexp_matches(split_part(url, '/', 3), '^[A-Za-z0-9][A-Za-z0-9_.-]*$') AS safe, list_contains(string_split(url, '/'), '..') AS climbs FROM pages")
def p37(s, d):
    parts = F.split("url", "/")
    return T.table(s, d, "pages").select("page_id", F.element_at(parts, 3).rlike("^[A-Za-z0-9][A-Za-z0-9_.-]*$").alias("safe"), F.array_contains(parts, "..").alias("climbs"))


@query("p39_path_component", "SELECT split_part(url, '/', 3) AS scene, count(*) AS n FROM pages GROUP BY 1")
def p39(s, d):
    return T.table(s, d, "pages").groupBy(F.element_at(F.split("url", "/"), 3).alias("scene")).agg(F.count("*").alias("n"))


# Filters


@query("f02_height_band", "SELECT count(*) FILTER (-1.0 - y >= 0.1 AND -1.0 - y <= 0.9) AS obstacle, count(*) FILTER (abs(y + 1.0) <= 0.2) AS ground, count(*) FILTER (x BETWEEN 2 AND 8 AND z BETWEEN 1 AND 5) AS inside FROM points", "points")
def f02(s, d):
    h = grid.height(c("y"), -1.0)
    return T.points(s, d).agg(F.count_if(h.between(0.1, 0.9)).alias("obstacle"), F.count_if(F.abs(c("y") + 1.0) <= 0.2).alias("ground"), F.count_if(grid.in_rectangle(c("x"), c("z"), 2, 8, 1, 5)).alias("inside"))


@query("f06_splat_filter", "SELECT id FROM splats WHERE x BETWEEN 1 AND 9 AND exp(log_scale) <= 5 AND 1 / (1 + exp(-opacity_logit)) >= 0.01", "splats")
def f06(s, d):
    return T.splats(s, d).where(c("x").between(1, 9) & (F.exp("log_scale") <= 5) & (numeric.sigmoid(c("opacity_logit")) >= 0.01)).select("id")


@query("f07_quantile_outliers", "SELECT id FROM splats, (SELECT quantile_cont(x, 0.02) AS lo, quantile_cont(x, 0.98) AS hi, quantile_cont(log_scale, 0.99) AS big FROM splats) q WHERE NOT (x < lo OR x > hi OR log_scale > big)", "splats")
def f07(s, d):
    g = T.splats(s, d)
    q = g.agg(F.percentile("x", F.lit(0.02)).alias("lo"), F.percentile("x", F.lit(0.98)).alias("hi"), F.percentile("log_scale", F.lit(0.99)).alias("big"))
    return g.join(F.broadcast(q), ~((c("x") < c("lo")) | (c("x") > c("hi")) | (c("log_scale") > c("big")))).select("id")


@query("f10_length_reasons", "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN NOT isfinite(length) THEN 'not finite' WHEN length < 5 THEN 'too short' WHEN length > 50 THEN 'too long' ELSE 'accepted' END AS reason FROM routes) GROUP BY 1", "routes")
def f10(s, d):
    why = F.when(~grid.finite(c("length")), "not finite").when(c("length") < 5, "too short").when(c("length") > 50, "too long").otherwise("accepted")
    return T.routes(s, d).groupBy(why.alias("reason")).agg(F.count("*").alias("n"))


# Joins

_CELLS = "cells AS (SELECT DISTINCT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j FROM points WHERE y < -1.0)"


def obstacle_cells(s, d):
    return T.points(s, d).where("y < -1.0").select(grid.cell(c("x"), 0.0, 0.1).alias("i"), grid.cell(c("z"), 0.0, 0.1).alias("j")).distinct()


@query("j01_classify_points", f", {_CELLS}, p AS (SELECT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j FROM points) SELECT cells.i IS NOT NULL AS hit, count(*) AS n FROM p LEFT JOIN cells USING (i, j) GROUP BY 1", "points")
def j01(s, d):
    p = T.points(s, d).select(grid.cell(c("x"), 0.0, 0.1).alias("i"), grid.cell(c("z"), 0.0, 0.1).alias("j"))
    return M.classified(p, obstacle_cells(s, d)).groupBy("hit").agg(F.count("*").alias("n"))


@query("j05_positional_zip", "SELECT n, id, vec_id FROM (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS n, s_suppkey AS id FROM supplier) a FULL JOIN (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS n, p_partkey AS vec_id FROM part) b USING (n)")
def j05(s, d):
    return M.positional(T.table(s, d, "supplier").select(c("s_suppkey").alias("id")), T.table(s, d, "part").select(c("p_partkey").alias("vec_id")), "id", "vec_id").select("n", "id", "vec_id")


@query("j06_metrics_by_id", "SELECT o_orderpriority AS kind, count(*) AS n, round(avg(length), 6) AS length FROM routes JOIN orders ON id = o_orderkey GROUP BY 1", "routes")
def j06(s, d):
    return T.routes(s, d).join(T.table(s, d, "orders").select(c("o_orderkey").alias("id"), "o_orderpriority"), "id").groupBy(c("o_orderpriority").alias("kind")).agg(F.count("*").alias("n"), r(F.avg("length")).alias("length"))


@query("j07_frames_in_ranges", "SELECT k, count(*) AS n FROM events JOIN (SELECT o_orderkey AS k, o_orderkey * 3 AS a, o_orderkey * 3 + o_custkey % 40 AS b FROM orders) q ON event_id BETWEEN a AND b GROUP BY 1")
def j07(s, d):
    q = T.table(s, d, "orders").select(c("o_orderkey").alias("k"), (c("o_orderkey") * 3).alias("a"), (c("o_orderkey") * 3 + c("o_custkey") % 40).alias("b"))
    return M.in_ranges(T.table(s, d, "events").select("event_id"), q, "event_id", "a", "b", 64).groupBy("k").agg(F.count("*").alias("n"))


@query("j08_hash_matches", "SELECT a.doc_id AS left_id, b.doc_id AS right_id FROM geometry a JOIN geometry b USING (h) WHERE a.part = 1 AND b.part = 2", "geometry")
def j08(s, d):
    g = T.geometry(s, d)
    return M.matches(g.where("part = 1"), g.where("part = 2"), "h", "doc_id", "doc_id").select("left_id", "right_id")


@query("j09_history_exclusion", "SELECT min(doc_id) AS doc_id FROM geometry WHERE part = 2 AND h NOT IN (SELECT h FROM geometry WHERE part = 0) GROUP BY h", "geometry")
def j09(s, d):
    g = T.geometry(s, d)
    return M.excluding(g.where("part = 2"), g.where("part = 0"), "h", "doc_id").select("doc_id")


@query("j11_close_endpoints", "SELECT a.id AS left_id, b.id AS right_id FROM splats a JOIN splats b ON a.id < b.id AND (a.x - b.x) * (a.x - b.x) + (a.z - b.z) * (a.z - b.z) <= 0.0025", "splats")
def j11(s, d):
    g = T.splats(s, d)
    return M.within(g, g, 0.05, "id", "id").where("left_id < right_id").select("left_id", "right_id")


@query("j12_key_sets", "SELECT (SELECT count(*) FROM (SELECT p_brand FROM part WHERE p_size < 5 INTERSECT SELECT p_brand FROM part WHERE p_size > 45)) AS both, (SELECT count(*) FROM (SELECT p_type FROM part WHERE p_size < 5 EXCEPT SELECT p_type FROM part WHERE p_size > 45)) AS only_left")
def j12(s, d):
    p = T.table(s, d, "part")
    both = p.where("p_size < 5").select("p_brand").intersect(p.where("p_size > 45").select("p_brand")).agg(F.count("*").alias("both"))
    left = p.where("p_size < 5").select("p_type").subtract(p.where("p_size > 45").select("p_type")).agg(F.count("*").alias("only_left"))
    return both.crossJoin(left)


@query("j15_box_overlap", "SELECT round(greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)), 6) AS width FROM (SELECT min(x) AS x0, max(x) AS x1 FROM points) a, (SELECT min(x) AS x0, max(x) AS x1 FROM splats) b", "points", "splats")
def j15(s, d):
    a = T.points(s, d).agg(F.min("x").alias("a0"), F.max("x").alias("a1"))
    b = T.splats(s, d).agg(F.min("x").alias("b0"), F.max("x").alias("b1"))
    return a.crossJoin(b).select(r(F.greatest(F.lit(0.0), F.least("a1", "b1") - F.greatest("a0", "b0"))).alias("width"))


# Aggregations


@query("a02_grid_counts", "SELECT * FROM (SELECT CAST(floor(x / 0.08::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.08::DOUBLE) AS BIGINT) AS j, count(*) FILTER (y < -1.5) AS obstacle, count(*) FILTER (abs(y + 0.5) <= 0.3) AS ground FROM points GROUP BY ALL) WHERE obstacle + ground > 0", "points")
def a02(s, d):
    return C.grid_counts(T.points(s, d), 0.08, obstacle=c("y") < -1.5, ground=F.abs(c("y") + 0.5) <= 0.3)


@query("a03_voxel_representative", ", v AS (SELECT floor(x / 0.5::DOUBLE) AS vi, floor(y / 0.5::DOUBLE) AS vj, floor(z / 0.5::DOUBLE) AS vk, x, y, z FROM points), e AS (SELECT *, (x - (vi + 0.5::DOUBLE) * 0.5::DOUBLE) * (x - (vi + 0.5::DOUBLE) * 0.5::DOUBLE) + (y - (vj + 0.5::DOUBLE) * 0.5::DOUBLE) * (y - (vj + 0.5::DOUBLE) * 0.5::DOUBLE) + (z - (vk + 0.5::DOUBLE) * 0.5::DOUBLE) * (z - (vk + 0.5::DOUBLE) * 0.5::DOUBLE) AS d2 FROM v) SELECT CAST(vi AS BIGINT) AS vi, CAST(vj AS BIGINT) AS vj, CAST(vk AS BIGINT) AS vk, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM (SELECT *, row_number() OVER (PARTITION BY vi, vj, vk ORDER BY d2, x, y, z) AS rn FROM e) WHERE rn = 1", "points")
def a03(s, d):
    return C.voxel_representatives(T.points(s, d), 0.5).select("vi", "vj", "vk", r(c("x")).alias("x"), r(c("y")).alias("y"), r(c("z")).alias("z"))


@query("a04_histogram", "SELECT CAST(least(179, floor((value - lo) / (hi - lo) * 180)) AS INTEGER) AS bin, count(*) AS n FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY 1")
def a04(s, d):
    return C.histogram(T.table(s, d, "events").select("value"), "value", 180)


@query("a06_floor_level", ", e AS (SELECT min(y) AS lo, max(y) AS hi FROM points), b AS (SELECT CAST(least(39, floor((y - lo) / ((hi - lo) / 40))) AS INTEGER) AS bin, lo, hi, count(DISTINCT (floor(x / 0.08::DOUBLE), floor(z / 0.08::DOUBLE))) AS coverage FROM points, e GROUP BY ALL) SELECT round(max(lo + (bin + 1) * ((hi - lo) / 40)), 6) AS floor_y FROM b WHERE coverage >= 0.25 * (SELECT max(coverage) FROM b)", "points")
def a06(s, d):
    return C.floor_level(T.points(s, d), 40, 0.08).select(r(c("floor_y")).alias("floor_y"))


@query("a08_length_statistics", "SELECT status, count(*) AS n, round(min(length), 6) AS least, round(max(length), 6) AS greatest, round(avg(length), 6) AS mean, round(stddev_pop(length), 6) AS std FROM routes GROUP BY 1", "routes")
def a08(s, d):
    return T.routes(s, d).groupBy("status").agg(F.count("*").alias("n"), r(F.min("length")).alias("least"), r(F.max("length")).alias("greatest"), r(F.avg("length")).alias("mean"), r(F.stddev_pop("length")).alias("std"))


_MOVED = "moved AS (SELECT ep, lead(x, 4) OVER w - x AS dx FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame))"
_STATS = "count(dx) AS n, round(avg(dx), 6) AS mean, round(stddev_pop(dx), 6) AS std, round(min(dx), 6) AS least, round(quantile_cont(dx, 0.01), 6) AS q01, round(quantile_cont(dx, 0.1), 6) AS q10, round(quantile_cont(dx, 0.5), 6) AS q50, round(quantile_cont(dx, 0.9), 6) AS q90, round(quantile_cont(dx, 0.99), 6) AS q99, round(max(dx), 6) AS greatest, round(avg((dx > 1e-6)::INT), 6) AS positive, round(avg((dx < -1e-6)::INT), 6) AS negative"


def _rounded(df, *keys):
    return df.select(*keys, "n", *[r(c(x)).alias(x) for x in df.columns if x not in (*keys, "n")])


@query("a09_displacement_summary", f", {_MOVED} SELECT {_STATS} FROM moved", "frames")
def a09(s, d):
    return _rounded(S.summary(S.displacement(T.frames(s, d), 4), "dx"))


@query("a10_side_split", f", {_MOVED} SELECT count(*) FILTER (dx < -0.5) AS lefts, count(*) FILTER (abs(dx) <= 0.5) AS centre, count(*) FILTER (dx > 0.5) AS rights, round(coalesce(sum(dx) FILTER (dx > 0.5), 0), 4) AS right_sum FROM moved WHERE dx IS NOT NULL", "frames")
def a10(s, d):
    m, dx = S.displacement(T.frames(s, d), 4), c("dx")
    return m.agg(F.count_if(dx < -0.5).alias("lefts"), F.count_if(F.abs(dx) <= 0.5).alias("centre"), F.count_if(dx > 0.5).alias("rights"), r(F.coalesce(F.sum(F.when(dx > 0.5, dx)), F.lit(0.0)), 4).alias("right_sum"))


@query("a11_scene_and_total", f", {_MOVED} SELECT ep, count(dx) AS n, round(avg(dx), 6) AS mean FROM moved WHERE dx IS NOT NULL GROUP BY GROUPING SETS ((ep), ())", "frames")
def a11(s, d):
    m = S.displacement(T.frames(s, d), 4)
    return m.groupingSets([[c("ep")], []], c("ep")).agg(F.count("dx").alias("n"), r(F.avg("dx")).alias("mean"))


_LEVELS = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


@query("a12_quantile_table", f"SELECT {list(_LEVELS)}[1 + k]::DOUBLE AS q, round(xs[1 + k], 6) AS x, round(zs[1 + k], 6) AS z FROM (SELECT quantile_cont(x, {list(_LEVELS)}) AS xs, quantile_cont(z, {list(_LEVELS)}) AS zs FROM splats), range({len(_LEVELS)}) t(k)", "splats")
def a12(s, d):
    levels = F.array(*[F.lit(q) for q in _LEVELS])
    got = T.splats(s, d).agg(F.percentile("x", levels).alias("xs"), F.percentile("z", levels).alias("zs"))
    return got.select(F.explode(F.arrays_zip(levels.alias("q"), "xs", "zs")).alias("t")).select(c("t.q").alias("q"), r(c("t.xs")).alias("x"), r(c("t.zs")).alias("z"))


@query("a15_reason_counts", "SELECT event_type AS reason, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, reason LIMIT 3")
def a15(s, d):
    return T.table(s, d, "events").groupBy(c("event_type").alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(3)


@query("a17_depth_quality", f", k AS (SELECT frame, {_CODE} AS code FROM depths) SELECT frame, count(*) AS total, count(*) FILTER (code > 0) AS valid, count(*) FILTER (code = 65535) AS saturated, min(nullif(code, 0)) AS least, max(nullif(code, 0)) AS greatest FROM k GROUP BY 1", "depths")
def a17(s, d):
    k = T.depths(s, d).select("frame", numeric.depth_code(c("metres")).alias("code"))
    some = F.nullif(c("code"), F.lit(0))
    return k.groupBy("frame").agg(F.count("*").alias("total"), F.count_if(c("code") > 0).alias("valid"), F.count_if(c("code") == 65535).alias("saturated"), F.min(some).alias("least"), F.max(some).alias("greatest"))


@query("a22_path_length", "SELECT ep, round(sum(sqrt((x - px) * (x - px) + (z - pz) * (z - pz))), 4) AS length FROM (SELECT ep, x, z, lag(x) OVER w AS px, lag(z) OVER w AS pz FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame)) GROUP BY 1", "frames")
def a22(s, d):
    m = S.displacement(T.frames(s, d), 1).withColumn("step", F.sqrt(c("dx") * c("dx") + c("dz") * c("dz")))
    every = T.frames(s, d).select("ep").distinct()
    return every.join(m.groupBy("ep").agg(F.sum("step").alias("s")), "ep", "left").select("ep", r(c("s"), 4).alias("length"))


@query("a23_tensor_delta", "SELECT label, round(sqrt(sum(d * d)), 6) AS l2, round(max(abs(d)), 6) AS greatest, bool_or(d <> 0) AS changed FROM (SELECT label, unnest(list_transform(range(1, 17), lambda k: a[k] - b[k])) AS d FROM poses) GROUP BY ROLLUP (label)", "poses")
def a23(s, d):
    x = T.poses(s, d).select("label", F.explode(F.zip_with("a", "b", lambda p, q: p - q)).alias("d"))
    return x.rollup("label").agg(r(F.sqrt(F.sum(c("d") * c("d")))).alias("l2"), r(F.max(F.abs("d"))).alias("greatest"), F.bool_or(c("d") != 0).alias("changed"))


@query("a24_first_last_least", "SELECT ep, first_x, last_x, least_at FROM (SELECT ep, min_by(x, frame) AS first_x, max_by(x, frame) AS last_x, min(x) AS lx FROM frames GROUP BY 1) JOIN (SELECT ep, min_by(frame, (x, frame)) AS least_at FROM frames GROUP BY 1) USING (ep)", "frames")
def a24(s, d):
    return T.frames(s, d).groupBy("ep").agg(F.min_by("x", "frame").alias("first_x"), F.max_by("x", "frame").alias("last_x"), F.min(F.struct("x", "frame"))["frame"].alias("least_at"))


@query("a27_zbuffer", "SELECT u, v, round(min(z), 6) AS depth FROM (SELECT CAST(floor(x * 4) AS BIGINT) AS u, CAST(floor(-y * 4) AS BIGINT) AS v, z FROM points) GROUP BY ALL", "points")
def a27(s, d):
    px = T.points(s, d).select(F.floor(c("x") * 4).cast("bigint").alias("u"), F.floor(-c("y") * 4).cast("bigint").alias("v"), c("z").alias("depth"))
    return M.zbuffer(px).select("u", "v", r(c("depth")).alias("depth"))


# Ordered sequences


@query("w01_tangents", ", f AS (SELECT *, CASE WHEN x = lag(x) OVER w AND z = lag(z) OVER w THEN 0 ELSE 1 END AS fresh FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame)), g AS (SELECT *, sum(fresh) OVER (PARTITION BY ep ORDER BY frame) AS run FROM f), h AS (SELECT ep, run, coalesce(lead(x) OVER v, x) - coalesce(lag(x) OVER v, x) AS dx, coalesce(lead(z) OVER v, z) - coalesce(lag(z) OVER v, z) AS dz FROM g WHERE fresh = 1 WINDOW v AS (PARTITION BY ep ORDER BY run)) SELECT ep, frame, round(dx / nullif(sqrt(dx * dx + dz * dz), 0), 6) AS fx, round(dz / nullif(sqrt(dx * dx + dz * dz), 0), 6) AS fz FROM g JOIN h USING (ep, run)", "frames")
def w01(s, d):
    return S.tangents(T.frames(s, d)).select("ep", "frame", r(c("fx")).alias("fx"), r(c("fz")).alias("fz"))


@query("w04_contiguity", "SELECT conv_id, min(turn) AS first, max(turn) AS last, count(*) AS n, max(turn) - min(turn) + 1 = count(*) AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY 1")
def w04(s, d):
    return S.gaps(T.table(s, d, "conversations"), "conv_id", "turn")


@query("w07_global_offsets", "SELECT ep, n, CAST(sum(n) OVER (ORDER BY ep) - n AS BIGINT) AS start FROM (SELECT ep, count(*) AS n FROM frames GROUP BY 1)", "frames")
def w07(s, d):
    return S.offsets(T.frames(s, d).groupBy("ep").agg(F.count("*").alias("n")), "ep", "n").select("ep", "n", "start")


@query("w08_cumulative", "SELECT ep, frame, round(sum(x) OVER (PARTITION BY ep ORDER BY frame ROWS UNBOUNDED PRECEDING), 4) AS total FROM frames", "frames")
def w08(s, d):
    w = S.ordered("ep", "frame").rowsBetween(Window.unboundedPreceding, 0)
    return T.frames(s, d).select("ep", "frame", r(F.sum("x").over(w), 4).alias("total"))


@query("w11_densify", ", g AS (SELECT ep, frame, x, z, lag(x) OVER w AS px, lag(z) OVER w AS pz FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame)), h AS (SELECT *, CASE WHEN px IS NULL THEN 1 ELSE CAST(greatest(1, ceil(sqrt((x - px) * (x - px) + (z - pz) * (z - pz)) * 0.05::DOUBLE)) AS INTEGER) END AS steps FROM g) SELECT ep, frame, CAST(k AS INTEGER) AS k, round(coalesce(px + (x - px) * (k / steps), x), 6) AS x, round(coalesce(pz + (z - pz) * (k / steps), z), 6) AS z FROM (SELECT *, unnest(range(1, steps + 1)) AS k FROM h)", "frames")
def w11(s, d):
    return S.densify(T.frames(s, d), 0.05).select("ep", "frame", "k", r(c("x")).alias("x"), r(c("z")).alias("z"))


@query("w12_chaikin", ", g AS (SELECT ep, frame, x, z, lead(x) OVER w AS nx, lead(z) OVER w AS nz, row_number() OVER w AS rn FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame)) SELECT ep, frame * 3 AS frame, round(x, 6) AS x, round(z, 6) AS z FROM g WHERE nx IS NULL OR rn = 1 UNION ALL SELECT ep, frame * 3 + 1, round(x * 0.75 + nx * 0.25, 6), round(z * 0.75 + nz * 0.25, 6) FROM g WHERE nx IS NOT NULL UNION ALL SELECT ep, frame * 3 + 2, round(x * 0.25 + nx * 0.75, 6), round(z * 0.25 + nz * 0.75, 6) FROM g WHERE nx IS NOT NULL", "frames")
def w12(s, d):
    return S.chaikin(T.frames(s, d)).select("ep", "frame", r(c("x")).alias("x"), r(c("z")).alias("z"))


@query("w13_smoothing", "SELECT ep, count(*) AS n, round(list_reduce([0.0::DOUBLE] || list(x ORDER BY frame), lambda v, q: v * 0.35::DOUBLE + q * 0.65::DOUBLE), 6) AS smoothed FROM frames GROUP BY 1", "frames")
def w13(s, d):
    return S.smoothed(T.frames(s, d), "x").select("ep", "n", r(c("smoothed")).alias("smoothed"))


# Sorting, sets, rasters


@query("s03_prefix_sample", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 500")
def s03(s, d):
    return T.table(s, d, "lineitem").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").limit(500).select("l_orderkey", "l_linenumber", "l_partkey")


@query("s05_bit_fields", "SELECT l_orderkey & 7 AS return_number, (l_orderkey >> 3) & 7 AS returns, (l_orderkey >> 6) & 1 AS scan_flag, count(*) AS n FROM lineitem GROUP BY ALL")
def s05(s, d):
    k = c("l_orderkey")
    return T.table(s, d, "lineitem").groupBy(k.bitwiseAND(7).alias("return_number"), F.shiftright(k, 3).bitwiseAND(7).alias("returns"), F.shiftright(k, 6).bitwiseAND(1).alias("scan_flag")).agg(F.count("*").alias("n"))


@query("s15_json_fields", "SELECT event_type, count(json_extract_string(props, '$.k')) AS with_k, count(*) AS n FROM events GROUP BY 1")
def s15(s, d):
    return T.table(s, d, "events").groupBy("event_type").agg(F.count(F.get_json_object("props", "$.k")).alias("with_k"), F.count("*").alias("n"))


@query("s18_polygon_area", "SELECT s_suppkey AS id, round(abs((2.0 * 2.0 - k * 1.0) + (k * 6.0 - 6.0 * 2.0) + (6.0 * 1.0 - 2.0 * 6.0)) / 2.0::DOUBLE, 6) AS area FROM (SELECT s_suppkey, (s_suppkey % 13)::DOUBLE AS k FROM supplier)")
def s18(s, d):
    """Areas of three-cornered regions, one for each supplier."""
    k = (c("s_suppkey") % 13).cast("double")
    corner = lambda x, z: F.struct(x.alias("x"), F.lit(z).alias("z"))
    v = F.array(corner(F.lit(2.0), 1.0), corner(k, 2.0), corner(F.lit(6.0), 6.0))
    nxt = F.concat(F.slice(v, 2, 2), F.slice(v, 1, 1))
    twice = F.aggregate(F.zip_with(v, nxt, lambda p, q: p["x"] * q["z"] - q["x"] * p["z"]), F.lit(0.0), lambda a, b: a + b)
    return T.table(s, d, "supplier").select(c("s_suppkey").alias("id"), r(F.abs(twice) / 2).alias("area"))


POLYGON = [(2.0, 1.0), (8.0, 2.0), (6.0, 6.0)]


@query("s23_content_hashes", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS size, sha256(text) AS sha FROM documents")
def s23(s, d):
    return T.table(s, d, "documents").select("doc_id", F.octet_length("text").alias("size"), F.sha2("text", 256).alias("sha"))


@query("t02_top_clearance", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 500")
def t02(s, d):
    return T.table(s, d, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(500)


@query("u05_duplicates", "SELECT h, count(*) AS n FROM geometry GROUP BY 1 HAVING count(*) > 1", "geometry")
def u05(s, d):
    return T.geometry(s, d).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")


@query("r02_dilate", f", {_CELLS}, {T.GRID} SELECT DISTINCT c.i + di AS i, c.j + dj AS j FROM cells c, range(-1, 2) a(di), range(-1, 2) b(dj), spec WHERE c.i + di BETWEEN 0 AND w - 1 AND c.j + dj BETWEEN 0 AND h - 1", "points")
def r02(s, d):
    return C.dilate(obstacle_cells(s, d), 1, *T.extent(s, d)).select("i", "j")


@query("r02_erode", f", {_CELLS}, {T.GRID}, far AS (SELECT DISTINCT g.i + di AS i, g.j + dj AS j FROM (SELECT * FROM grid ANTI JOIN cells USING (i, j)) g, range(-1, 2) a(di), range(-1, 2) b(dj)) SELECT i, j FROM cells ANTI JOIN far USING (i, j)", "points")
def r02e(s, d):
    return C.erode(obstacle_cells(s, d), 1, *T.extent(s, d)).select("i", "j")


_BOX = "SELECT {a}.i + di AS i, {a}.j + dj AS j FROM {a}, range(-1, 2) a(di), range(-1, 2) b(dj), spec WHERE {a}.i + di BETWEEN 0 AND w - 1 AND {a}.j + dj BETWEEN 0 AND h - 1"
_OPENED = f"out1 AS (SELECT * FROM grid ANTI JOIN cells USING (i, j)), far1 AS (SELECT DISTINCT * FROM ({_BOX.format(a='out1')})), left1 AS (SELECT i, j FROM cells ANTI JOIN far1 USING (i, j))"
_CLOSED = f"wide2 AS (SELECT DISTINCT * FROM ({_BOX.format(a='cells')})), out2 AS (SELECT * FROM grid ANTI JOIN wide2 USING (i, j)), far2 AS (SELECT DISTINCT * FROM ({_BOX.format(a='out2')}))"


@query("r02_open", f", {_CELLS}, {T.GRID}, {_OPENED} SELECT DISTINCT * FROM ({_BOX.format(a='left1')})", "points")
def r02o(s, d):
    return C.opened(obstacle_cells(s, d), 1, *T.extent(s, d)).select("i", "j")


@query("r02_close", f", {_CELLS}, {T.GRID}, {_CLOSED} SELECT i, j FROM wide2 ANTI JOIN far2 USING (i, j)", "points")
def r02c(s, d):
    return C.closed(obstacle_cells(s, d), 1, *T.extent(s, d)).select("i", "j")


@query("r03_dilate_disc", f", {_CELLS}, {T.GRID}, k AS (SELECT dx, dy FROM range(-3, 4) a(dx), range(-3, 4) b(dy) WHERE abs(dx) <= round_even(3 * sqrt(1 - dy * dy / 9.0::DOUBLE), 0)) SELECT DISTINCT c.i + dx AS i, c.j + dy AS j FROM cells c, k, spec WHERE c.i + dx BETWEEN 0 AND w - 1 AND c.j + dy BETWEEN 0 AND h - 1", "points")
def r03(s, d):
    return C.dilate_disc(obstacle_cells(s, d), 3, *T.extent(s, d)).select("i", "j")


_NEAR = "near AS (SELECT i, j, min(d2) AS d2 FROM (SELECT c.i + di AS i, c.j + dj AS j, di * di + dj * dj AS d2 FROM cells c, range(-5, 6) a(di), range(-5, 6) b(dj) WHERE di * di + dj * dj <= 25) JOIN grid USING (i, j) GROUP BY ALL), rest AS (SELECT g.i, g.j, min((g.i - c.i) * (g.i - c.i) + (g.j - c.j) * (g.j - c.j)) AS d2 FROM (SELECT * FROM grid ANTI JOIN near USING (i, j)) g, cells c GROUP BY ALL)"


@query("r07_distance", f", {_CELLS}, {T.GRID}, {_NEAR} SELECT i, j, round(sqrt(d2) * 0.1::DOUBLE, 6) AS distance_m FROM (SELECT * FROM near UNION ALL SELECT * FROM rest)", "points")
def r07(s, d):
    return C.grid_distance(obstacle_cells(s, d), *T.extent(s, d), 0.1, 0.5, digits=6)


@query("r08_polygon_cells", f", {T.GRID} SELECT i, j FROM (SELECT i, j, (i + 0.5::DOUBLE) * 0.1::DOUBLE AS x, (j + 0.5::DOUBLE) * 0.1::DOUBLE AS z FROM grid) WHERE 6 * (z - 1) - 1 * (x - 2) >= -1e-9 AND -2 * (z - 2) - 4 * (x - 8) >= -1e-9 AND -4 * (z - 6) + 5 * (x - 6) >= -1e-9", "points")
def r08(s, d):
    return C.grid(s, *T.extent(s, d)).where(C.in_polygon(grid.cell_centre(c("i"), 0.0, 0.1), grid.cell_centre(c("j"), 0.0, 0.1), POLYGON))


@query("r10_boundary_sides", f", {_CELLS} SELECT c.i, c.j, di, dj FROM cells c, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) t(di, dj) WHERE NOT EXISTS (SELECT 1 FROM cells n WHERE n.i = c.i + di AND n.j = c.j + dj)", "points")
def r10(s, d):
    return C.boundary(obstacle_cells(s, d)).select("i", "j", "di", "dj")


# Verdicts


@query("v02_frame_contract", "SELECT ep, count(*) AS n, min(frame) = 0 AND max(frame) + 1 = count(*) AND bool_and(isfinite(x) AND isfinite(z)) AS valid FROM frames GROUP BY 1", "frames")
def v02(s, d):
    f = T.frames(s, d)
    return f.groupBy("ep").agg(F.count("*").alias("n"), ((F.min("frame") == 0) & (F.max("frame") + 1 == F.count("*")) & F.bool_and(grid.finite(c("x")) & grid.finite(c("z")))).alias("valid"))


@query("v07_acceptance", "SELECT count(*) AS n, count(DISTINCT id) = count(*) AS unique_ids, min(length) >= 0 AS positive, count(*) = (SELECT count(*) FROM orders) AS complete FROM routes", "routes")
def v07(s, d):
    expected = T.table(s, d, "orders").agg(F.count("*").alias("expected"))
    got = T.routes(s, d).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.min("length").alias("least"))
    return got.crossJoin(expected).select("n", (c("ids") == c("n")).alias("unique_ids"), (c("least") >= 0).alias("positive"), (c("n") == c("expected")).alias("complete"))


@query("v10_matrix_shape", "SELECT vec_id, len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda v: isfinite(v))) AS valid FROM embeddings")
def v10(s, d):
    ok = (F.size("embedding") == 64) & F.forall("embedding", grid.finite)
    return T.table(s, d, "embeddings").select("vec_id", ok.alias("valid"))


from . import artifacts, manifests, poses, rasters  # noqa: E402,F401  they add theirs
