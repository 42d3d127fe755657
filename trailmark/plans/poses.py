"""Queries on poses, cameras, depth images and ordered frames."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import grid, numeric, pose
from ..operators import sequences as S
from . import carriers as T
from .registry import c, query, r

FLOOR, LIFT = 2.0, 0.53  # floor level and height of the base above it
MOUNT = (0.3, 0.0, 0.12)  # offset of the camera in the base


def rounded(m, digits: int = 6):
    return F.transform(m, lambda v: r(v, digits))


def _list(*items: str, digits: int = 6) -> str:
    return f"list_transform([{', '.join(items)}]::DOUBLE[], lambda v: round(v, {digits}) + 0.0::DOUBLE)"


def ground(s, d, lift: float = 0.0):
    return T.rigid(s, d).withColumn("m", pose.ground_pose(c("x"), c("z"), c("fx"), c("fz"), FLOOR, lift))


def damaged(s, d):
    """ground, with every fiftieth frame's rotation scaled by 1.01."""
    bad = F.when(c("frame") % 50 == 7, 1.01).otherwise(1.0)
    return ground(s, d).withColumn("m", F.transform("m", lambda v, k: F.when((k < 12) & (k % 4 != 3), v * bad).otherwise(v)))


@query("p02_axes", "SELECT l_orderkey, round(x, 6) + 0.0 AS x, round(-z, 6) + 0.0 AS y, round(y, 6) + 0.0 AS z FROM points", "points")
def p02(s, d):
    x, y, z = grid.z_up_to_y_down(c("x"), c("y"), c("z"))
    return T.points(s, d).select("l_orderkey", r(x).alias("x"), r(y).alias("y"), r(z).alias("z"))


@query("p07_region_bounds", "SELECT round(avg(x) - 6.5, 6) AS x0, round(avg(x) + 6.5, 6) AS x1, round(avg(z) - 3.5, 6) AS z0, round(avg(z) + 3.5, 6) AS z1 FROM points", "points")
def p07(s, d):
    bounds = grid.region_bounds(F.avg("x"), F.avg("z"), 12.0, 6.0, 0.5)
    return T.points(s, d).agg(*[r(b).alias(n) for n, b in zip(("x0", "x1", "z0", "z1"), bounds, strict=True)])


@query("p08_height", "SELECT l_orderkey, round(-1.0::DOUBLE - y, 6) + 0.0 AS h FROM points", "points")
def p08(s, d):
    return T.points(s, d).select("l_orderkey", r(grid.height(c("y"), -1.0)).alias("h"))


@query("p10_splat_scale", "SELECT id, round(greatest(exp(log_scale), exp(log_scale / 2), exp(-log_scale)), 9) AS scale FROM splats", "splats")
def p10(s, d):
    return T.splats(s, d).select("id", r(F.greatest(F.exp("log_scale"), F.exp(c("log_scale") / 2), F.exp(-c("log_scale"))), 9).alias("scale"))


@query("p13_rigid_inverse", f"SELECT ep, frame, {_list('fx', '0', 'fz', '-(fx * x + fz * z)', '-fz', '0', 'fx', 'fz * x - fx * z', '0', '-1', '0', '2.0', '0', '0', '0', '1')} AS m FROM rigid", "frames", "rigid")
def p13(s, d):
    return ground(s, d).select("ep", "frame", rounded(pose.rigid_inverse(c("m"))).alias("m"))


_ANGLES = "(SELECT vec_id, radians(label * 7 % 360) AS a, radians(vec_id % 89 - 44) AS b, radians(vec_id % 360) AS g FROM embeddings)"


@query("p15_rotation_from_degrees", f"SELECT vec_id, {_list('cos(g) * cos(b)', 'cos(g) * sin(b) * sin(a) - sin(g) * cos(a)', 'cos(g) * sin(b) * cos(a) + sin(g) * sin(a)', 'sin(g) * cos(b)', 'sin(g) * sin(b) * sin(a) + cos(g) * cos(a)', 'sin(g) * sin(b) * cos(a) - cos(g) * sin(a)', '-sin(b)', 'cos(b) * sin(a)', 'cos(b) * cos(a)', digits=9)} AS m FROM {_ANGLES}")
def p15(s, d):
    m = pose.rotation_from_degrees(c("label") * 7 % 360, c("vec_id") % 89 - 44, c("vec_id") % 360)
    return T.table(s, d, "embeddings").select("vec_id", rounded(m, 9).alias("m"))


@query("p16_camera_pose", f"SELECT ep, frame, {_list('fz', '0', 'fx', 'x + 0.3 * fx', '0', '1', '0', '2.0 - 0.53 - 0.12', '-fx', '0', 'fz', 'z + 0.3 * fz', '0', '0', '0', '1')} AS m FROM rigid", "frames", "rigid")
def p16(s, d):
    return ground(s, d, LIFT).select("ep", "frame", rounded(pose.matmul(c("m"), pose.camera_mount(*MOUNT))).alias("m"))


@query("p17_ground_pose", f"SELECT ep, frame, {_list('fx', '-fz', '0', 'x', '0', '0', '-1', '2.0', 'fz', 'fx', '0', 'z', '0', '0', '0', '1')} AS m FROM rigid", "frames", "rigid")
def p17(s, d):
    return ground(s, d).select("ep", "frame", rounded(c("m")).alias("m"))


@query("p18_base_pose", f"SELECT ep, frame, {_list('fx', '-fz', '0', 'x', '0', '0', '-1', '1.47', 'fz', 'fx', '0', 'z', '0', '0', '0', '1')} AS m FROM rigid", "frames", "rigid")
def p18(s, d):
    return ground(s, d, LIFT).select("ep", "frame", rounded(c("m")).alias("m"))


@query("p20_pose_chain", f"SELECT ep, frame, {_list('0', '0', '1', '0.3', '-1', '0', '0', '0', '0', '-1', '0', '0.65', '0', '0', '0', '1')} AS m FROM rigid", "frames", "rigid")
def p20(s, d):
    base = pose.ground_pose(c("x"), c("z"), c("fx"), c("fz"), FLOOR, LIFT)
    chain = pose.matmul(pose.rigid_inverse(c("m")), pose.matmul(base, pose.camera_mount(*MOUNT)))
    return ground(s, d).select("ep", "frame", rounded(chain).alias("m"))


@query("p23_intrinsics", "SELECT DISTINCT label, [400.0 + label, 0, 424, 0, 400.0 + label, 240, 0, 0, 1]::DOUBLE[] AS k FROM embeddings")
def p23(s, d):
    f = c("label") + F.lit(400.0)
    return T.table(s, d, "embeddings").select("label", pose.intrinsics(f, f, F.lit(424.0), F.lit(240.0)).alias("k")).distinct()


_FWD = "(SELECT *, sqrt((tx - ex) * (tx - ex) + (tz - ez) * (tz - ez) + (ty - ey) * (ty - ey)) AS n FROM (SELECT vec_id, a[1] AS ex, a[2] AS ey, a[3] AS ez, a[4] AS tx, a[5] AS ty, a[6] AS tz FROM poses))"
_VIEW = f"SELECT *, -vz / h AS rx, vx / h AS rz FROM (SELECT *, sqrt(vx * vx + vz * vz) AS h FROM (SELECT *, (tx - ex) / n AS vx, (ty - ey) / n AS vy, (tz - ez) / n AS vz FROM {_FWD}))"


@query("p24_look_at", f", v AS ({_VIEW}), w AS (SELECT *, vy * rz AS dx, vz * rx - vx * rz AS dy, -vy * rx AS dz FROM v) SELECT vec_id, {_list('rx', '0', 'rz', '-(rx * ex + rz * ez)', 'dx', 'dy', 'dz', '-(dx * ex + dy * ey + dz * ez)', 'vx', 'vy', 'vz', '-(vx * ex + vy * ey + vz * ez)', '0', '0', '0', '1')} AS m FROM w", "poses")
def p24(s, d):
    m = pose.look_at([c("a")[k] for k in range(3)], [c("a")[k] for k in range(3, 6)], [0.0, 1.0, 0.0])
    return T.poses(s, d).select("vec_id", rounded(m).alias("m"))


@query("p27_colour_of_16_bits", "SELECT l_partkey, CAST(trunc(least(1.0::DOUBLE, (l_partkey * 31 % 65536) / 65535.0::DOUBLE * 1.5::DOUBLE) * 255.0::DOUBLE) AS INTEGER) AS red, count(*) AS n FROM lineitem GROUP BY ALL")
def p27(s, d):
    return T.table(s, d, "lineitem").groupBy("l_partkey", numeric.colour_of_16_bits(c("l_partkey") * 31 % 65536, 1.5).alias("red")).agg(F.count("*").alias("n"))


_ENDS = "(SELECT quantile_cont(metres, 0.01) AS lo, greatest(quantile_cont(metres, 0.99), quantile_cont(metres, 0.01) + 1e-6) AS hi FROM depths WHERE metres > 0.1)"


@query("p29_adaptive_depth", f"SELECT frame, pos, CASE WHEN metres > 0.1 THEN CAST(trunc(least(50000, greatest(1, least(1, greatest(0, (metres - lo) / (hi - lo))) * 50000.0::DOUBLE))) AS INTEGER) ELSE 0 END AS code FROM depths, {_ENDS}", "depths")
def p29(s, d):
    rows = T.depths(s, d)
    return rows.crossJoin(F.broadcast(numeric.stretch_ends(rows, c("metres"), c("metres") > 0.1))).select("frame", "pos", F.when(c("metres") > 0.1, numeric.stretch_code(c("metres"), c("lo"), c("hi"))).otherwise(0).alias("code"))


@query("p31_colour_classes", "SELECT hit, count(*) AS n FROM (SELECT sqrt(l_tax * l_tax + l_discount * l_discount + pow((l_partkey % 256) / 255.0::DOUBLE - 0.5, 2)) < 0.05 AS hit FROM lineitem) GROUP BY 1")
def p31(s, d):
    hit = numeric.colour_distance([c("l_tax"), c("l_discount"), c("l_partkey") % 256 / 255.0], (0.0, 0.0, 0.5)) < 0.05
    return T.table(s, d, "lineitem").groupBy(hit.alias("hit")).agg(F.count("*").alias("n"))


@query("p33_axis_adapter", "SELECT ep, frame, z AS forward, 0.0 - x AS side FROM frames", "frames")
def p33(s, d):
    return T.frames(s, d).select("ep", "frame", c("z").alias("forward"), (F.lit(0.0) - c("x")).alias("side"))


_LOCAL = "moved AS (SELECT ep, frame, fx, fz, lead(x, 4) OVER w - x AS dx, lead(z, 4) OVER w - z AS dz FROM rigid WINDOW w AS (PARTITION BY ep ORDER BY frame))"


@query("p34_local_displacement", f", {_LOCAL} SELECT ep, frame, round(fx * dx + fz * dz, 6) + 0.0 AS forward, round(fx * dz - fz * dx, 6) + 0.0 AS side FROM moved WHERE dx IS NOT NULL", "frames", "rigid")
def p34(s, d):
    forward, left = pose.to_local(c("dx"), c("dz"), c("fx"), c("fz"))
    return S.displacement(T.rigid(s, d), 4).select("ep", "frame", r(forward).alias("forward"), r(left).alias("side"))


@query("p35_quantised_hash", "SELECT ep, sha256(string_agg(CAST(CAST(round(x * 1e8) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round(z * 1e8) AS BIGINT) AS VARCHAR), ';' ORDER BY frame)) AS h FROM frames GROUP BY 1", "frames")
def p35(s, d):
    return S.geometry_hash(T.frames(s, d)).select("ep", "h")


@query("p42_viewport", "SELECT l_orderkey, round((x - 12) * 37.5, 4) AS u, round((z + 4) * 37.5, 4) AS v, (x - 12) * 37.5 BETWEEN 0 AND 640 AND (z + 4) * 37.5 BETWEEN 0 AND 480 AS shown, round(x, 6) AS x, round(z, 6) AS z FROM points", "points")
def p42(s, d):
    """Screen places, whether they are shown, and the way back."""
    u, v = grid.to_screen(c("x"), c("z"), 37.5, 12.0, -4.0)
    x, z = grid.from_screen(u, v, 37.5, 12.0, -4.0)
    return T.points(s, d).select("l_orderkey", r(u, 4).alias("u"), r(v, 4).alias("v"), (u.between(0, 640) & v.between(0, 480)).alias("shown"), r(x).alias("x"), r(z).alias("z"))


@query("f08_frustum", "SELECT count(*) AS n FROM (SELECT z - 5 AS d, round_even(400 * (x - 10) / (z - 5) + 424, 0) AS u, round_even(400 * y / (z - 5) + 240, 0) AS v FROM points WHERE z > 5) WHERE d BETWEEN 0.1 AND 4 AND u >= 0 AND u < 848 AND v >= 0 AND v < 480", "points")
def f08(s, d):
    u, v = pose.project(c("x") - 10, c("y"), c("z") - 5, 400.0, 400.0, 424.0, 240.0)
    seen = T.points(s, d).select((c("z") - 5).alias("d"), F.rint(u).alias("u"), F.rint(v).alias("v"))
    return seen.where(c("d").between(0.1, 4) & (c("u") >= 0) & (c("u") < 848) & (c("v") >= 0) & (c("v") < 480)).agg(F.count("*").alias("n"))


@query("f09_alpha_validity", "SELECT frame, count(*) FILTER (metres / 6 >= 0.5) AS valid FROM depths GROUP BY 1", "depths")
def f09(s, d):
    return T.depths(s, d).groupBy("frame").agg(F.count_if(c("metres") / 6 >= 0.5).alias("valid"))


@query("f11_close_matrices", "SELECT vec_id, list_bool_and(list_transform(range(1, 17), lambda k: abs(a[k] - b[k]) <= 0.2::DOUBLE + 0.5::DOUBLE * abs(b[k]))) AS same FROM poses", "poses")
def f11(s, d):
    return T.poses(s, d).select("vec_id", pose.close(c("a"), c("b"), 0.2, 0.5).alias("same"))


@query("f15_stop_code", "SELECT event_id, CASE WHEN abs(value - round(value, 0)) < 1e-5 THEN 0.0::DOUBLE ELSE value END AS stiffness FROM events")
def f15(s, d):
    return T.table(s, d, "events").select("event_id", numeric.unless_stopped(c("value"), c("value"), F.round("value", 0)).alias("stiffness"))


@query("j13_static_matrix", f"SELECT e.ep, e.frame, {_list('fz * q + x', '2.0', 'z - fx * q')} AS p FROM rigid e, (SELECT 2.0::DOUBLE AS q)", "frames", "rigid")
def j13(s, d):
    static = s.range(1).select(F.array(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, -2.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0)]).alias("k"))
    m = ground(s, d).crossJoin(F.broadcast(static)).select("ep", "frame", pose.matmul(c("m"), c("k")).alias("m"))
    return m.select("ep", "frame", rounded(F.array(c("m")[3], c("m")[7], c("m")[11])).alias("p"))


@query("a18_sampled_depth_report", ", f AS (FROM (SELECT DISTINCT frame FROM depths) ORDER BY md5('0:' || frame), frame LIMIT 16) SELECT frame, min(metres) AS least, max(metres) AS greatest FROM depths SEMI JOIN f USING (frame) GROUP BY 1", "depths")
def a18(s, d):
    return S.sampled_depths(T.depths(s, d), 16, 0)


@query("a19_contract_error", ", f AS (SELECT CASE WHEN frame % 50 = 7 THEN 1.01::DOUBLE * 1.01::DOUBLE - 1 ELSE 0 END AS e, greatest(1, abs(x), abs(z), 2.0) AS t FROM rigid) SELECT count(*) AS n, round(max(e * t), 6) AS inverse_error, round(max(e), 6) AS orthonormal_error, count(*) FILTER (e > 1e-6) AS bad FROM f", "frames", "rigid")
def a19(s, d):
    """Errors of M * inverse - I and R'R - I; some rotations are scaled first."""
    one = F.array(*[F.lit(1.0 if i % 5 == 0 else 0.0) for i in range(16)])
    off = F.array_max(F.zip_with(pose.matmul(c("m"), pose.rigid_inverse(c("m"))), one, lambda x, y: F.abs(x - y)))
    error = pose.orthonormal_error(c("m"))
    return damaged(s, d).agg(F.count("*").alias("n"), r(F.max(off)).alias("inverse_error"), r(F.max(error)).alias("orthonormal_error"), F.count_if(error > 1e-6).alias("bad"))


@query("a20_all_finite", "SELECT label, bool_and(list_bool_and(list_transform(embedding, lambda v: isfinite(v)))) AS finite FROM embeddings GROUP BY 1")
def a20(s, d):
    return T.table(s, d, "embeddings").groupBy("label").agg(F.bool_and(F.forall("embedding", grid.finite)).alias("finite"))


_DOTS = "dots AS (SELECT ep, frame, (fx * dx + fz * dz) / sqrt(dx * dx + dz * dz) AS dot FROM (SELECT ep, frame, fx, fz, lead(x) OVER w - x AS dx, lead(z) OVER w - z AS dz FROM rigid WINDOW w AS (PARTITION BY ep ORDER BY frame)) WHERE dx * dx + dz * dz > 1e-18)"


@query("a21_pose_statistics", f", {_DOTS} SELECT ep, count(*) AS n, round(min(dot), 6) AS least, round(avg(dot), 6) AS mean FROM dots GROUP BY 1", "frames", "rigid")
def a21(s, d):
    return S.motion_cosines(T.rigid(s, d)).groupBy("ep").agg(F.count("*").alias("n"), r(F.min("dot")).alias("least"), r(F.avg("dot")).alias("mean"))


@query("a29_out_of_range", "SELECT count(*) FILTER (v < 0) AS below, count(*) FILTER (v > 0.3) AS above, count(*) AS n FROM (SELECT unnest(embedding) AS v FROM embeddings)")
def a29(s, d):
    v = T.table(s, d, "embeddings").select(F.explode("embedding").alias("v"))
    return v.agg(F.count_if(c("v") < 0).alias("below"), F.count_if(c("v") > 0.3).alias("above"), F.count("*").alias("n"))


@query("a30_contact_force", "SELECT event_type, round(sum(value) / count(DISTINCT user_id), 4) AS force FROM events GROUP BY 1")
def a30(s, d):
    return T.table(s, d, "events").groupBy("event_type").agg(r(F.sum("value") / F.countDistinct("user_id"), 4).alias("force"))


@query("w02_displacement", "SELECT * FROM (SELECT ep, frame, round(lead(x, 3) OVER w - x, 6) + 0.0 AS dx, round(lead(z, 3) OVER w - z, 6) + 0.0 AS dz FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame)) WHERE dx IS NOT NULL", "frames")
def w02(s, d):
    return S.displacement(T.frames(s, d), 3).select("ep", "frame", r(c("dx")).alias("dx"), r(c("dz")).alias("dz"))


@query("w03_motion_cosines", f", {_DOTS} SELECT ep, frame, round(dot, 6) + 0.0 AS dot FROM dots", "frames", "rigid")
def w03(s, d):
    return S.motion_cosines(T.rigid(s, d)).select("ep", "frame", r(c("dot")).alias("dot"))


@query("w06_local_index", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events")
def w06(s, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return T.table(s, d, "events").select("event_id", (F.row_number().over(w) - 1).cast("bigint").alias("k"))


@query("w14_interpolation", "SELECT vec_id, k, round(a[1] + (b[1] - a[1]) * k / 10.0::DOUBLE, 9) + 0.0 AS q FROM poses, range(0, 11) t(k)", "poses")
def w14(s, d):
    steps = T.poses(s, d).select("vec_id", c("a")[0].alias("p"), c("b")[0].alias("q"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(10).cast("bigint"))).alias("k"))
    return steps.select("vec_id", "k", r(c("p") + (c("q") - c("p")) * c("k") / 10.0, 9).alias("q"))


@query("v01_camera_contract", "SELECT ep, count(*) AS n, bool_and(frame % 50 <> 7) AS rigid, bool_and(isfinite(x) AND event_id % 211 <> 5) AS finite FROM (SELECT *, user_id AS u FROM rigid JOIN (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events) e ON e.user_id = ep AND e.k = frame) GROUP BY 1", "frames", "rigid")
def v01(s, d):
    """Scaled rotations and places that are no numbers are found."""
    marks = T.frames(s, d).select("ep", "frame", "event_id")
    lost = F.when(c("event_id") % 211 == 5, F.lit(float("nan"))).otherwise(c("m")[3])
    m = F.col("m")
    holed = damaged(s, d).join(marks, ["ep", "frame"]).withColumn("m", F.concat(F.slice("m", 1, 3), F.array(lost), F.slice("m", 5, 12)))
    rigid = (pose.orthonormal_error(m) <= 1e-6) & (F.abs(pose.determinant3(m) - 1) <= 1e-6)
    return holed.groupBy("ep").agg(F.count("*").alias("n"), F.bool_and(rigid).alias("rigid"), F.bool_and(F.forall(m, grid.finite)).alias("finite"))


@query("m05_path_to_cameras", f", f AS (SELECT *, CASE WHEN x = lag(x) OVER w AND z = lag(z) OVER w THEN 0 ELSE 1 END AS fresh FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame)), g AS (SELECT *, sum(fresh) OVER (PARTITION BY ep ORDER BY frame) AS run FROM f), h AS (SELECT ep, run, coalesce(lead(x) OVER v, x) - coalesce(lag(x) OVER v, x) AS dx, coalesce(lead(z) OVER v, z) - coalesce(lag(z) OVER v, z) AS dz FROM g WHERE fresh = 1 WINDOW v AS (PARTITION BY ep ORDER BY run)), t AS (SELECT ep, frame, x, z, dx / sqrt(dx * dx + dz * dz) AS fx, dz / sqrt(dx * dx + dz * dz) AS fz FROM g JOIN h USING (ep, run) WHERE dx * dx + dz * dz > 0) SELECT ep, frame, {_list('fz', '0', 'fx', 'x + 0.3 * fx', '0', '1', '0', '2.0 - 0.53 - 0.12', '-fx', '0', 'fz', 'z + 0.3 * fz', '0', '0', '0', '1')} AS m FROM t", "frames")
def m05(s, d):
    base = pose.ground_pose(c("x"), c("z"), c("fx"), c("fz"), FLOOR, LIFT)
    return S.tangents(T.frames(s, d)).where("fx is not null").select("ep", "frame", rounded(pose.matmul(base, pose.camera_mount(*MOUNT))).alias("m"))


@query("m07_bias_audit", f", {_LOCAL} SELECT ep, count(*) AS n, round(avg(side), 6) + 0.0 AS mean_side, count(*) FILTER (side > 0.5) AS lefts, count(*) FILTER (side < -0.5) AS rights FROM (SELECT ep, fx * dz - fz * dx AS side FROM moved WHERE dx IS NOT NULL) GROUP BY GROUPING SETS ((ep), ())", "frames", "rigid")
def m07(s, d):
    side = pose.to_local(c("dx"), c("dz"), c("fx"), c("fz"))[1]
    m = S.displacement(T.rigid(s, d), 4).select("ep", side.alias("side"))
    return m.groupingSets([[c("ep")], []], c("ep")).agg(F.count("*").alias("n"), r(F.avg("side")).alias("mean_side"), F.count_if(c("side") > 0.5).alias("lefts"), F.count_if(c("side") < -0.5).alias("rights"))
