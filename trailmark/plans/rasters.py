"""Queries on cells, masks, clouds and routes over a grid."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import grid, numeric
from ..operators import cells as C
from ..operators import matching as M
from ..operators import planner, search
from ..sources.shared import new_folder
from . import carriers as T
from .registry import c, query, r

ROI = [(2.0, 1.0), (18.0, 1.0), (18.0, 9.0), (2.0, 9.0)]

_CELLS = "cells AS (SELECT DISTINCT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j FROM points WHERE y < -2.4)"
_GRID = T.GRID


def obstacles(s, d):
    return T.points(s, d).where("y < -2.4").select(grid.cell(c("x"), 0.0, 0.1).alias("i"), grid.cell(c("z"), 0.0, 0.1).alias("j")).distinct()


def region(s, d):
    return C.polygon_cells(s, ROI, (0.0, 0.0), 0.1, *T.extent(s, d))


@query("f01_rectangle", "SELECT l_orderkey, round(x, 6) AS x, round(z, 6) AS z FROM points WHERE x BETWEEN 2 AND 8 AND z BETWEEN 1 AND 5", "points")
def f01(s, d):
    return T.points(s, d).where(grid.in_rectangle(c("x"), c("z"), 2, 8, 1, 5)).select("l_orderkey", r(c("x")).alias("x"), r(c("z")).alias("z"))


@query("f03_ground_band", "SELECT count(*) AS n FROM points WHERE abs(y + 1.0) <= 0.2", "points")
def f03(s, d):
    return T.points(s, d).where(F.abs(c("y") + 1.0) <= 0.2).agg(F.count("*").alias("n"))


@query("f04_in_grid", "SELECT i >= 0 AND i < 150 AND j >= 0 AND j < 80 AS ok, count(*) AS n FROM (SELECT CAST(floor((x - 1.0) / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor((z - 1.0) / 0.1::DOUBLE) AS BIGINT) AS j FROM points) GROUP BY 1", "points")
def f04(s, d):
    ok = grid.in_grid(grid.cell(c("x"), 1.0, 0.1), grid.cell(c("z"), 1.0, 0.1), 150, 80)
    return T.points(s, d).groupBy(ok.alias("ok")).agg(F.count("*").alias("n"))


@query("s02_point_scan", "SELECT count(*) AS n, round(sum(x), 2) AS x, round(sum(z), 2) AS z FROM points", "points")
def s02(s, d):
    return T.points(s, d).agg(F.count("*").alias("n"), r(F.sum("x"), 2).alias("x"), r(F.sum("z"), 2).alias("z"))


@query("j02_fine_cells", f", {_CELLS} SELECT fi AS i, fj AS j FROM (SELECT i, j, i * 5 // 2 - 1 + a AS fi, j * 5 // 2 - 1 + b AS fj FROM cells, range(0, 6) t(a), range(0, 6) u(b)) WHERE fi >= 0 AND fj >= 0 AND (2 * fi + 1) * 40 // 200 = i AND (2 * fj + 1) * 40 // 200 = j", "points")
def j02(s, d):
    return C.resampled(obstacles(s, d), 100, 40)


@query("j03_path_collisions", f", {_CELLS}, {_GRID} SELECT ep, bool_or(cells.i IS NOT NULL OR p.i < 0 OR p.i >= w OR p.j < 0 OR p.j >= h) AS collides FROM spec, (SELECT ep, CAST(floor(x / 2.5) AS BIGINT) AS i, CAST(floor(z) AS BIGINT) AS j FROM frames) p LEFT JOIN cells USING (i, j) GROUP BY 1", "points", "frames")
def j03(s, d):
    path = T.frames(s, d).select("ep", grid.cell(c("x"), 0.0, 2.5).alias("i"), grid.cell(c("z"), 0.0, 1.0).alias("j"))
    return C.collisions(path, obstacles(s, d), *T.extent(s, d))


@query("j10_nearest_occupied", "SELECT a.id, round(sqrt(min((a.x - b.x) * (a.x - b.x) + (a.z - b.z) * (a.z - b.z))), 6) AS metres FROM splats a, splats b WHERE a.id % 2 = 0 AND b.id % 2 = 1 GROUP BY 1", "splats")
def j10(s, d):
    g = T.splats(s, d).where("abs(x) < double('inf') and abs(z) < double('inf')")  # other points are near none
    near = M.nearest(g.where("id % 2 = 0"), g.where("id % 2 = 1"))
    return near.groupBy("id").agg(r(F.sqrt(F.min("d2"))).alias("metres"))


@query("a01_cell_counts", "SELECT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j, count(*) AS n FROM points GROUP BY ALL", "points")
def a01(s, d):
    return C.grid_counts(T.points(s, d), 0.1, n=F.lit(True))


@query("a05_bin_coverage", "SELECT CAST(floor(y / 0.25::DOUBLE) AS BIGINT) AS bin, count(DISTINCT (floor(x / 0.1::DOUBLE), floor(z / 0.1::DOUBLE))) AS coverage FROM points GROUP BY 1", "points")
def a05(s, d):
    return T.points(s, d).groupBy(grid.cell(c("y"), 0.0, 0.25).alias("bin")).agg(F.countDistinct(grid.cell(c("x"), 0.0, 0.1), grid.cell(c("z"), 0.0, 0.1)).alias("coverage"))


_FOCUS = """, e AS (SELECT min(x) AS lx, max(x) AS hx, min(z) AS lz, max(z) AS hz FROM splats),
p AS (SELECT x, z, least(1.0::DOUBLE, greatest(0.05::DOUBLE, 1 / (1 + exp(-opacity_logit)))) AS w, CAST(least(19, floor((x - lx) / greatest(hx - lx, 1e-6) * 20)) AS BIGINT) AS i, CAST(least(19, floor((z - lz) / greatest(hz - lz, 1e-6) * 20)) AS BIGINT) AS j FROM splats, e),
k AS (SELECT i AS pi, j AS pj FROM p GROUP BY i, j ORDER BY round(sum(w), 9) DESC, j, i LIMIT 1),
g AS (SELECT *, greatest(1, abs(i - pi), abs(j - pj)) AS ring FROM p, k),
c AS (SELECT CASE WHEN count(*) FILTER (ring <= 1) >= 256 THEN 1 WHEN count(*) FILTER (ring <= 2) >= 256 THEN 2 WHEN count(*) FILTER (ring <= 3) >= 256 THEN 3 ELSE 4 END AS reach FROM g),
f AS (SELECT x, z, w FROM g, c WHERE ring <= reach), m AS (SELECT sum(w * x) / sum(w) AS tx, sum(w * z) / sum(w) AS tz FROM f)
SELECT round(any_value(tx), 6) AS x, round(any_value(tz), 6) AS z, count(*) AS n, round(quantile_cont(sqrt((x - tx) * (x - tx) + (z - tz) * (z - tz)), 0.95), 6) AS radius FROM f, m"""


@query("a07_dense_focus", _FOCUS, "splats")
def a07(s, d):
    weight = F.least(F.lit(1.0), F.greatest(F.lit(0.05), numeric.sigmoid(c("opacity_logit"))))
    return C.dense_focus(T.splats(s, d), weight, 20).select(r(c("tx")).alias("x"), r(c("tz")).alias("z"), "n", r(c("radius")).alias("radius"))


@query("a13_bounds", "SELECT round(min(x), 6) AS x0, round(max(x), 6) AS x1, round(min(y), 6) + 0.0 AS y0, round(max(y), 6) + 0.0 AS y1, round(min(z), 6) AS z0, round(max(z), 6) AS z1 FROM points", "points")
def a13(s, d):
    return T.points(s, d).agg(*[r(f(a)).alias(f"{a}{k}") for a in "xyz" for k, f in ((0, F.min), (1, F.max))])


@query("a14_mask_cross_table", "SELECT count(*) FILTER (x > 5 AND log_scale > 0) AS both, count(*) FILTER (x > 5 AND NOT log_scale > 0) AS only_far, count(*) FILTER (NOT x > 5 AND log_scale > 0) AS only_large FROM splats", "splats")
def a14(s, d):
    far, large = c("x") > 5, c("log_scale") > 0
    return T.splats(s, d).agg(F.count_if(far & large).alias("both"), F.count_if(far & ~large).alias("only_far"), F.count_if(~far & large).alias("only_large"))


@query("a28_unique_rounded", "SELECT DISTINCT round(z, 1) AS z, round(y, 1) + 0.0 AS y FROM points", "points")
def a28(s, d):
    return T.points(s, d).select(r(c("z"), 1).alias("z"), r(c("y"), 1).alias("y")).distinct()


@query("t09_nearest_free", f""", {_CELLS}, {_GRID}, free AS (SELECT * FROM grid ANTI JOIN cells USING (i, j)),
reach AS (SELECT q.i AS qi, q.j AS qj, q.i + a AS i, q.j + b AS j, greatest(abs(a), abs(b)) AS ring, a * a + b * b AS d2 FROM cells q, range(-12, 13) t(a), range(-12, 13) u(b)),
o AS (SELECT reach.*, CASE WHEN j = greatest(0, qj - ring) THEN 0 WHEN j = least(h - 1, qj + ring) THEN 1 WHEN i = greatest(0, qi - ring) THEN 2 ELSE 3 END AS side FROM reach JOIN free USING (i, j), spec)
SELECT qi * 4294967296 + qj AS id, i, j FROM o QUALIFY row_number() OVER (PARTITION BY qi, qj ORDER BY ring, d2, side, CASE WHEN side < 2 THEN i ELSE j END) = 1""", "points")
def t09(s, d):
    solid, (w, h) = obstacles(s, d), T.extent(s, d)
    return C.nearest_unblocked(solid.select((c("i") * F.lit(1 << 32) + c("j")).alias("id"), "i", "j"), solid, w, h)


@query("u01_cloud_union", "SELECT 'obstacle' AS kind, count(*) AS n FROM points WHERE y < -2.0 UNION ALL SELECT 'context', count(*) FROM points WHERE NOT y < -2.0", "points")
def u01(s, d):
    p = T.points(s, d)
    part = lambda name, cond: p.where(cond).select(F.lit(name).alias("kind"))
    return part("obstacle", c("y") < -2.0).unionByName(part("context", ~(c("y") < -2.0))).groupBy("kind").agg(F.count("*").alias("n"))


_GROUND = "ground AS (SELECT DISTINCT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j FROM points WHERE y > -1.2)"
_WIDE = "wide AS (SELECT DISTINCT c.i + di AS i, c.j + dj AS j FROM cells c, range(-1, 2) a(di), range(-1, 2) b(dj), spec WHERE c.i + di BETWEEN 0 AND w - 1 AND c.j + dj BETWEEN 0 AND h - 1)"


def ground(s, d):
    return T.points(s, d).where("y > -1.2").select(grid.cell(c("x"), 0.0, 0.1).alias("i"), grid.cell(c("z"), 0.0, 0.1).alias("j")).distinct()


def free_cells(s, d):
    """Ground cells that no inflated obstacle blocks."""
    return ground(s, d).join(C.dilate(obstacles(s, d), 1, *T.extent(s, d)), ["i", "j"], "left_anti")


@query("u07_mask_algebra", f", {_CELLS}, {_GRID}, {_GROUND}, {_WIDE} SELECT i, j FROM wide UNION SELECT i, j FROM grid ANTI JOIN ground USING (i, j)", "points")
def u07(s, d):
    return C.complement(free_cells(s, d), *T.extent(s, d))


@query("r01_threshold_mask", "SELECT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j FROM points GROUP BY ALL HAVING count(*) >= 3", "points")
def r01(s, d):
    return C.grid_counts(T.points(s, d), 0.1, n=F.lit(True)).where("n >= 3").select("i", "j")


_DISC = "disc AS (SELECT dx, dy FROM range(-3, 4) a(dx), range(-3, 4) b(dy) WHERE abs(dx) <= round_even(3 * sqrt(1 - dy * dy / 9.0::DOUBLE), 0))"
_ROI = "roi AS (SELECT i, j FROM grid WHERE (i + 0.5) * 0.1 BETWEEN 2 AND 18 AND (j + 0.5) * 0.1 BETWEEN 1 AND 9), lost AS (SELECT DISTINCT g.i + dx AS i, g.j + dy AS j FROM (SELECT * FROM grid ANTI JOIN roi USING (i, j)) g, disc)"


@query("r04_eroded_region", f", {_CELLS}, {_GRID}, {_DISC}, {_ROI} SELECT i, j FROM roi ANTI JOIN lost USING (i, j)", "points")
def r04(s, d):
    return C.erode_disc(region(s, d), 3, *T.extent(s, d))


_REACH = ", reach(i, j, label) AS (SELECT i, j, i * 2147483648 + j FROM cells UNION SELECT c.i, c.j, least(r.label, c.i * 2147483648 + c.j) FROM reach r JOIN cells c ON c.i - r.i BETWEEN -1 AND 1 AND c.j - r.j BETWEEN -1 AND 1), labelled AS (SELECT i, j, min(label) AS label FROM reach GROUP BY 1, 2)"


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("r05_components", recursive(T.with_("points") + f", {_CELLS}{_REACH} SELECT i, j, label, size FROM labelled JOIN (SELECT label, count(*) AS size FROM labelled GROUP BY 1 HAVING count(*) >= 3) USING (label)"))
def r05(s, d):
    return C.components(obstacles(s, d), 3, new_folder(s, "components")).select("i", "j", "label", "size")


@query("r06_largest_component", recursive(T.with_("points") + f", {_CELLS}{_REACH} SELECT i, j FROM labelled WHERE label = (SELECT label FROM labelled GROUP BY 1 ORDER BY count(*) DESC, label LIMIT 1)"))
def r06(s, d):
    return C.largest(C.labelled(obstacles(s, d), new_folder(s, "components")))


@query("r09_sampling_cells", f", {_CELLS}, {_GRID}, {_GROUND}, {_WIDE}, {_DISC}, {_ROI} SELECT i, j FROM ground ANTI JOIN wide USING (i, j) SEMI JOIN roi USING (i, j) ANTI JOIN lost USING (i, j)", "points")
def r09(s, d):
    return free_cells(s, d).join(C.erode_disc(region(s, d), 3, *T.extent(s, d)), ["i", "j"], "left_semi")


def segments(s, d):
    part, (w, h) = T.table(s, d, "part"), T.extent(s, d)
    return part.select(c("p_partkey").alias("id"), (c("p_partkey") * 37 % w).alias("i0"), (c("p_partkey") * 53 % h).alias("j0"), (c("p_partkey") * 91 % w).alias("i1"), (c("p_size") * 2 % h).cast("bigint").alias("j1"))


@query("r11_line_of_sight", f", {_CELLS}, {_GRID}, seg AS (SELECT p_partkey AS id, p_partkey * 37 % w AS i0, p_partkey * 53 % h AS j0, p_partkey * 91 % w AS i1, p_size * 2 % h AS j1 FROM part, spec), n AS (SELECT *, abs(i1 - i0) AS dx, abs(j1 - j0) AS dz, greatest(abs(i1 - i0), abs(j1 - j0)) AS n FROM seg), l AS (SELECT id, i0 + sign(i1 - i0) * CASE WHEN n = 0 THEN 0 ELSE (2 * dx * k + n - 1) // (2 * n) END AS i, j0 + sign(j1 - j0) * CASE WHEN n = 0 THEN 0 ELSE (2 * dz * k + n - 1) // (2 * n) END AS j FROM (SELECT *, unnest(range(0, n + 1)) AS k FROM n)) SELECT id, bool_and(cells.i IS NULL) AS free FROM l LEFT JOIN cells ON cells.i = l.i AND cells.j = l.j GROUP BY 1", "points")
def r11(s, d):
    return C.lines_free(segments(s, d), obstacles(s, d)).select("id", "free")


def clearance(s, d):
    """Blocked cells, and the way from each cell to the nearest of them; half a metre where there is none."""
    solid, (w, h) = obstacles(s, d), T.extent(s, d)
    kind = "i4" if w * w + h * h < 1 << 31 else "i8"
    rows = dict(C.packed_squares(solid, w, h, kind).toArrow().to_pandas().itertuples(index=False))
    near = search.Clearance([rows[j] for j in range(h)] if rows else [search.packed(np.full(w, 25, kind))] * h, w, 0.1, kind)
    return near.squares == 0, near


@query("r12_least_cost_routes", None)
def r12(s, d):
    """Routes between the segments' ends."""
    found = search.routes(segments(s, d), *clearance(s, d))
    return found.select("id", r(c("cost")).alias("cost"), F.size("cells").cast("bigint").alias("n"))


@query("k12_log_stretch", ", n AS (SELECT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j, count(*) AS n FROM points GROUP BY ALL) SELECT i, j, CAST(trunc(least(255.0, ln(1 + n) / ln(1 + hi) * 255.0)) AS INTEGER) AS shade FROM n, (SELECT quantile_cont(n, 0.95) AS hi FROM n)", "points")
def k12(s, d):
    n = C.grid_counts(T.points(s, d), 0.1, n=F.lit(True))
    high = n.agg(F.percentile("n", F.lit(0.95)).alias("hi"))
    return n.crossJoin(F.broadcast(high)).select("i", "j", numeric.stretch(c("n"), c("hi")).cast("int").alias("shade"))


@query("m01_scene_layers", f", {_CELLS}, {_GRID}, {_GROUND}, {_WIDE} SELECT (SELECT count(*) FROM cells) AS obstacle, (SELECT count(*) FROM wide) AS inflated, (SELECT count(*) FROM ground) AS ground, (SELECT count(*) FROM ground ANTI JOIN wide USING (i, j)) AS free", "points")
def m01(s, d):
    solid = obstacles(s, d)
    layers = {"obstacle": solid, "inflated": C.dilate(solid, 1, *T.extent(s, d)), "ground": ground(s, d), "free": free_cells(s, d)}
    out = None
    for name, layer in layers.items():
        one = layer.agg(F.count("*").alias(name))
        out = one if out is None else out.crossJoin(one)
    return out


def _voxels(source: str, size: str) -> str:
    return f"(SELECT x, y, z FROM (SELECT *, floor(x / {size}) AS a, floor(y / {size}) AS b, floor(z / {size}) AS c FROM {source}) QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY pow(x - (a + 0.5::DOUBLE) * {size}, 2) + pow(y - (b + 0.5::DOUBLE) * {size}, 2) + pow(z - (c + 0.5::DOUBLE) * {size}, 2), x, y, z) = 1)"


@query("m03_semantic_cloud", f", {_CELLS}, marked AS (SELECT p.x, p.y, p.z, c.i IS NOT NULL AS hit FROM points p LEFT JOIN cells c ON c.i = CAST(floor(p.x / 0.1::DOUBLE) AS BIGINT) AND c.j = CAST(floor(p.z / 0.1::DOUBLE) AS BIGINT)), o AS (SELECT * FROM marked WHERE hit), k AS (SELECT * FROM marked WHERE NOT hit) SELECT 'obstacle' AS kind, count(*) AS n FROM {_voxels('o', '0.3::DOUBLE')} UNION ALL SELECT 'context', count(*) FROM {_voxels('k', '0.5::DOUBLE')}", "points")
def m03(s, d):
    p = T.points(s, d).withColumns({"i": grid.cell(c("x"), 0.0, 0.1), "j": grid.cell(c("z"), 0.0, 0.1)})
    marked = M.classified(p, obstacles(s, d))
    part = lambda name, cond, size: C.voxel_representatives(marked.where(cond), size).select(F.lit(name).alias("kind"))
    cloud = part("obstacle", c("hit"), 0.3).unionByName(part("context", ~c("hit"), 0.5))
    return cloud.groupBy("kind").agg(F.count("*").alias("n"))


@query("r16_planned_batch", None)
def r16(s, d):
    """Routes that keep apart, one for each nation: a third with a start, a third with a goal, the rest drawn."""
    blocked, near = clearance(s, d)
    plan = planner.Map(blocked, near, 0.1)
    h, w = blocked.shape
    place = lambda k, a, b: (k * a % w * 0.1 + 0.05, k * b % h * 0.1 + 0.05)
    keys = [x.n_nationkey for x in T.table(s, d, "nation").select("n_nationkey").orderBy("n_nationkey").toLocalIterator()]
    asked = [(k, place(k + 1, 37, 53) if k % 3 == 1 else None, place(k + 5, 91, 29) if k % 3 == 2 else None) for k in keys]
    routes, _ = planner.batch(s, asked, plan, planner.Rules(min_separation=0.1))
    return routes.select("route", "attempt", "i0", "j0", "i1", "j1", r(c("length"), 4).alias("length"), F.size("points").cast("bigint").alias("n"))
