"""Queries that write files into the shared folder and read them back: episodes, manifests, clouds, layers, settings."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import sources
from ..functions import grid, pose
from ..operators import sequences as S
from ..sources import folders, ply, settings
from ..sources.shared import new_folder
from . import carriers as T
from .registry import c, query, r

_STEPS = "steps AS (SELECT ep, frame, x, z, lead(x) OVER w - x AS dx, lead(z) OVER w - z AS dz FROM frames WINDOW w AS (PARTITION BY ep ORDER BY frame))"


def written(s, name: str, write, check=lambda path: None) -> str:
    path = new_folder(s, name)
    folders.publish(s, path, write, check)
    return path


@query("s12_schema_scan", "SELECT column_name AS name, CAST(ordinal_position - 1 AS BIGINT) AS pos, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE data_type END AS type FROM information_schema.columns WHERE table_name = 'part'")
def s12(s, d):
    return folders.fields(T.table(s, d, "part"))


def episodes(s, d) -> str:
    rows = T.frames(s, d).select("ep", "frame", "x", "z", "event_id")
    return written(s, "episodes", lambda path: folders.write_episodes(rows, path))


@query("k01_episode_files", "SELECT ep, count(*) AS n, 1::BIGINT AS files, round(sum(x), 6) AS x, CAST(sum(frame * event_id) AS BIGINT) AS mark FROM frames GROUP BY 1", "frames")
def k01(s, d):
    read = s.read.parquet(episodes(s, d)).withColumn("file", F.input_file_name())
    return read.groupBy(c("ep").cast("bigint").alias("ep")).agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"), r(F.sum("x")).alias("x"), F.sum(c("frame") * c("event_id")).alias("mark"))


@query("s13_listed_files", "SELECT DISTINCT 'ep=' || user_id AS folder FROM events")
def s13(s, d):
    files = folders.listing(s, episodes(s, d), "*.parquet")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct()


@query("s24_tree_usage", "SELECT count(DISTINCT user_id) AS files, true AS filled FROM events")
def s24(s, d):
    return folders.usage(folders.listing(s, episodes(s, d), "*.parquet")).select("files", (c("bytes") > 0).alias("filled"))


@query("k02_nested_lists", "SELECT vec_id, embedding[7]::DOUBLE AS cell, round(list_sum(embedding[1:16]::DOUBLE[]), 5) AS total FROM embeddings")
def k02(s, d):
    rows = folders.matrices(T.poses(s, d).select("vec_id", c("a").alias("m")), {"m": (4, 4)})
    read = s.read.parquet(written(s, "nested", lambda path: rows.write.parquet(path)))
    total = F.aggregate(F.flatten("m"), F.lit(0.0), lambda a, b: a + b)
    return read.select("vec_id", c("m")[1][2].cast("double").alias("cell"), r(total, 5).alias("total"))


@query("k03_json_manifest", "SELECT count(*) AS n, round(sum(length), 4) AS metres, min(length) AS least, max(length) AS greatest, count(DISTINCT seed) AS seeds FROM routes", "routes")
def k03(s, d):
    facts = T.routes(s, d).agg(F.count("*").alias("n"), r(F.sum("length"), 4).alias("metres"), F.min("length").alias("least"), F.max("length").alias("greatest"), F.countDistinct("seed").alias("seeds"))
    path = written(s, "manifest", lambda at: facts.coalesce(1).select(F.to_json(F.struct("*"))).write.text(at))
    return s.read.schema(facts.schema).json(path)


@query("k04_json_lines", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority, o_totalprice FROM orders")
def k04(s, d):
    rows = T.table(s, d, "orders").select("o_orderkey", F.when(c("o_orderstatus") != "F", c("o_orderpriority")).alias("priority"), "o_totalprice")
    return s.read.schema(rows.schema).json(written(s, "lines", lambda path: folders.write_lines(rows, path)))


@query("k07_csv", "SELECT p_partkey, p_name || ', \"' || p_brand || '\"' AS title, p_size, p_retailprice FROM part")
def k07(s, d):
    rows = T.table(s, d, "part").select("p_partkey", F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("title"), "p_size", "p_retailprice")
    path = written(s, "csv", lambda at: folders.write_csv(rows, at))
    return s.read.schema(rows.schema).option("header", True).option("escape", '"').csv(path)


@query("s06_ply_scan", "SELECT row_number() OVER (ORDER BY id) - 1 AS pos, x::FLOAT::DOUBLE AS x, z::FLOAT::DOUBLE AS z, id % 256 AS red FROM splats", "splats")
def s06(s, d):
    """Written and read as PLY: the file's header gives the columns."""
    sources.register(s)
    rows = T.splats(s, d).select(c("id").alias("__id"), c("x").cast("float").alias("x"), c("z").cast("float").alias("z"), (c("id") % 256).cast("int").alias("red"))
    path = new_folder(s, "cloud").removeprefix("file://") + ".ply"
    ply.write_ply(rows, path, ["__id"], ("red",))
    return s.read.format("ply").load(path).select("pos", c("x").cast("double").alias("x"), c("z").cast("double").alias("z"), c("red").cast("bigint").alias("red"))


@query("k05_ply_order", "SELECT hit, count(*) AS n, min(pos) AS first, max(pos) AS last FROM (SELECT x < 5 AS hit, row_number() OVER (ORDER BY x >= 5, id) - 1 AS pos FROM splats) GROUP BY 1", "splats")
def k05(s, d):
    """Obstacle rows come first in the file, then context."""
    sources.register(s)
    rows = T.splats(s, d).select((c("x") >= 5).alias("__context"), c("id").alias("__id"), c("x").cast("float").alias("x"))
    path = new_folder(s, "cloud").removeprefix("file://") + ".ply"
    ply.write_ply(rows, path, ["__context", "__id"])
    read = s.read.format("ply").load(path).groupBy((c("x") < 5).alias("hit"))
    return read.agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))


def obstacles(s, d):
    at = [grid.cell(c(a), 0.0, 0.1).alias(b) for a, b in (("x", "i"), ("z", "j"))]
    return T.points(s, d).where("y < -2.4").select(*at).distinct()


_CELLS = "cells AS (SELECT DISTINCT CAST(floor(x / 0.1::DOUBLE) AS BIGINT) AS i, CAST(floor(z / 0.1::DOUBLE) AS BIGINT) AS j FROM points WHERE y < -2.4)"


@query("s20_scene_arrays", f", {_CELLS} SELECT 'blocked' AS layer, i, j FROM cells", "points")
def s20(s, d):
    """A scene's layers as compressed arrays of cells, one folder a layer."""
    rows = obstacles(s, d).withColumn("layer", F.lit("blocked"))
    path = written(s, "layers", lambda at: rows.write.option("compression", "zstd").partitionBy("layer").parquet(at))
    return s.read.parquet(path).select("layer", "i", "j")


@query("m02_verified_scene", f", {_CELLS} SELECT count(*) AS n, max(i) + 1 AS w, max(j) + 1 AS h, true AS intact, true AS altered_found FROM cells", "points")
def m02(s, d):
    """A scene with its manifest: bounds, count and a hash of its cells, checked when it is loaded; a changed layer is found."""
    def facts(cells):
        at = cells.agg(F.count("*").alias("n"), F.max("i").alias("w"), F.max("j").alias("h"), F.sum(F.xxhash64("i", "j").cast("decimal(38)")).cast("string").alias("mark"))
        return json.loads(at.select(F.to_json(F.struct("*")).alias("j")).first().j)

    def write(path):
        obstacles(s, d).write.parquet(f"{path}/layer")
        folders.Store(s, path).write_text(f"{path}/manifest.json", json.dumps(facts(s.read.parquet(f"{path}/layer"))))

    path = written(s, "scene", write)
    told, layer = json.loads(folders.Store(s, path).read_text(f"{path}/manifest.json")), s.read.parquet(f"{path}/layer")
    altered = facts(layer.withColumn("i", F.when(c("i") == told["w"], c("i") - 1).otherwise(c("i"))))
    return s.createDataFrame([(told["n"], told["w"] + 1, told["h"] + 1, facts(layer) == told, altered["mark"] != told["mark"])], "n bigint, w bigint, h bigint, intact boolean, altered_found boolean")


@query("k11_atomic_publish", "SELECT count(*) AS n, true AS refused, true AS kept, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS replaced FROM orders")
def k11(s, d):
    """Published; published again without leave (refused); with a check that fails (the old one stays); replaced."""
    rows = T.table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    some = rows.where("o_orderstatus = 'F'")

    def complete(path):
        if s.read.parquet(path).where("o_orderstatus <> 'F'").isEmpty():
            raise ValueError("a status is missing")

    path = written(s, "published", lambda at: rows.write.parquet(at), complete)
    n, refused, kept = s.read.parquet(path).count(), False, False
    try:
        folders.publish(s, path, lambda at: some.write.parquet(at), lambda at: None)
    except FileExistsError:
        refused = True
    try:
        folders.publish(s, path, lambda at: some.write.parquet(at), complete, overwrite=True)
    except ValueError:
        kept = s.read.parquet(path).count() == n
    folders.publish(s, path, lambda at: some.write.parquet(at), lambda at: None, overwrite=True)
    return s.read.parquet(path).agg(F.lit(n).cast("bigint").alias("n"), F.lit(refused).alias("refused"), F.lit(kept).alias("kept"), F.count("*").alias("replaced"))


def converted(s, d):
    """Frames of all episodes by local and by global index, with their ground pose and the step to the next frame as nested lists."""
    rows = T.rigid(s, d).join(T.ranges(s, d), "ep").withColumn("original_index", c("first") + c("frame"))
    flat = rows.withColumn("pose", pose.change_of_world(pose.ground_pose(c("x"), c("z"), c("fx"), c("fz"), 0.0)))
    return folders.matrices(flat.select("ep", c("frame").alias("index"), "original_index", "pose"), {"pose": (4, 4)})


@query("m06_converted_episodes", 'SELECT ep, count(*) AS frame_count, CAST(0 AS BIGINT) AS converted_min, count(*) - 1 AS converted_max, min(first) AS original_min, min("last") AS original_max, round(sum(x::FLOAT::DOUBLE), 3) AS x, round(sum(-(z::FLOAT::DOUBLE)), 3) AS y FROM rigid JOIN ranges USING (ep) GROUP BY 1', "frames", "rigid", "ranges")
def m06(s, d):
    rows = converted(s, d)
    read = s.read.parquet(written(s, "converted", lambda path: folders.write_episodes(rows, path, order="index")))
    i, o, m = c("index"), c("original_index"), c("pose")
    return read.groupBy(c("ep").cast("bigint").alias("ep")).agg(F.count("*").alias("frame_count"), F.min(i).alias("converted_min"), F.max(i).alias("converted_max"), F.min(o).alias("original_min"), F.max(o).alias("original_max"), r(F.sum(m[0][3].cast("double")), 3).alias("x"), r(F.sum(m[1][3].cast("double")), 3).alias("y"))


@query("v03_converted_contract", "SELECT user_id AS ep, CASE WHEN user_id % 7 = 3 THEN count(*) ELSE 0 END AS wrong_index, CASE WHEN user_id % 5 = 2 THEN count(*) ELSE 0 END AS wrong_pose FROM events GROUP BY 1")
def v03(s, d):
    """The converted set against its sources, made again; every seventh episode's index and every fifth one's poses are damaged first."""
    shift = F.when(c("ep") % 7 == 3, 1).otherwise(0)
    bad = F.when(c("ep") % 5 == 2, F.reverse("pose")).otherwise(c("pose"))
    damaged = converted(s, d).withColumns({"index": c("index") + shift, "pose": bad})
    read = s.read.parquet(written(s, "damaged", lambda path: folders.write_episodes(damaged, path, order="index"))).withColumn("ep", c("ep").cast("bigint"))
    both = converted(s, d).alias("a").join(read.alias("b"), ["ep", "original_index"], "full")
    wrong = lambda name: F.count_if(~c(f"a.{name}").eqNullSafe(c(f"b.{name}"))).alias(f"wrong_{name}")
    return both.groupBy("ep").agg(wrong("index"), wrong("pose"))


@query("m04_route_rows", f", {_STEPS} SELECT ep, count(*) AS n, round(sum(sqrt(dx * dx + dz * dz)), 4) AS metres FROM steps GROUP BY 1", "frames")
def m04(s, d):
    """Each route as a JSON object with its points in order and its length."""
    step = S.displacement(T.frames(s, d), 1).groupBy("ep").agg(r(F.sum(F.sqrt(c("dx") * c("dx") + c("dz") * c("dz"))), 4).alias("metres"))
    line = T.frames(s, d).groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("frame", "x", "z"))).alias("points"))
    rows = line.join(step, "ep", "left")
    read = s.read.schema(rows.schema).json(written(s, "routes", lambda path: folders.write_lines(rows, path)))
    return read.select("ep", F.size("points").cast("bigint").alias("n"), "metres")


@query("m08_batch_fingerprints", "SELECT part, count(*) AS records, count(DISTINCT h) AS fingerprints, count(*) - count(DISTINCT h) AS repeated FROM geometry GROUP BY 1", "geometry")
def m08(s, d):
    """Batches of records with fingerprints, written as lines and loaded by folder."""
    rows = T.geometry(s, d)
    path = written(s, "batches", lambda at: rows.write.partitionBy("part").json(at))
    read = folders.required(s.read.schema("doc_id bigint, h string, part bigint").json(path), ["part", "doc_id", "h"])
    return read.groupBy("part").agg(F.count("*").alias("records"), F.countDistinct("h").alias("fingerprints"), (F.count("*") - F.countDistinct("h")).alias("repeated"))


@query("m10_schema_guard", "SELECT 'part' AS name, count(*) AS n, 'missing columns: opacity, scale_0' AS refusal FROM part")
def m10(s, d):
    part, refusal = T.table(s, d, "part"), None
    try:
        folders.required(part, ["p_partkey", "opacity", "scale_0"])
    except ValueError as e:
        refusal = str(e)
    return folders.required(part, ["p_partkey"]).agg(F.lit("part").alias("name"), F.count("*").alias("n"), F.lit(refusal).alias("refusal"))


@query("k13_region_files", "SELECT s_suppkey AS id, round(abs((s_suppkey % 7) - 3) * 4.0::DOUBLE, 6) AS area, s_suppkey % 7 = 3 AS refused FROM supplier")
def k13(s, d):
    """A region file for each supplier, written and read back on the executors; one without an area is refused."""
    side = ((c("s_suppkey") % 7) - 3).cast("double")
    shapes = T.table(s, d, "supplier").select(c("s_suppkey").alias("id"), F.abs(side).alias("side"))

    def task(batches):
        for batch in batches:
            out = []
            for w in batch["side"]:
                try:
                    region = settings.Region(0.1, (0.0, 0.0), ((1.0, 1.0), (1.0 + w, 1.0), (1.0 + w, 5.0), (1.0, 5.0)))
                    back = settings.load_region(settings.dump_region(region))
                    out.append((abs(settings.area(back.polygon)), back != region))
                except ValueError:
                    out.append((0.0, True))
            yield batch[["id"]].assign(area=[round(a, 6) for a, _ in out], refused=[b for _, b in out])

    return shapes.mapInPandas(task, "id long, area double, refused boolean")


@query("p41_formatted_values", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE printf('%.3f', value) END || ' / ' || lpad(CAST(event_id AS VARCHAR), 6, '0') AS line FROM events")
def p41(s, d):
    v = F.when(c("event_id") % 5 != 0, F.format_string("%.3f", "value"))
    return T.table(s, d, "events").select("event_id", F.concat(F.coalesce(v, F.lit("none")), F.lit(" / "), F.lpad(c("event_id").cast("string"), 6, "0")).alias("line"))


@query("s23_tree_hash", "SELECT region AS name, sha256(region) AS sha FROM (SELECT r_name AS region FROM region)")
def s23(s, d):
    """Hash of each file of a folder, read whole as binary rows."""
    names = T.table(s, d, "region").select("r_name")
    path = written(s, "texts", lambda at: names.withColumn("part", c("r_name")).repartition("part").write.partitionBy("part").option("lineSep", "\0").text(at))
    files = s.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
    body = F.regexp_replace(c("content").cast("string"), "\0$", "")
    return files.select(body.alias("name"), F.sha2(body, 256).alias("sha"))


_DRAW = "('0x' || substr(md5({0}), 1, 8))::BIGINT"


@query("t06_nested_draws", f", n AS (SELECT ep, count(*) AS n FROM frames GROUP BY 1), a AS (SELECT ep, n, {_DRAW.format(chr(39) + '11:' + chr(39) + ' || ep')} % n AS start FROM n) SELECT ep, start, start + {_DRAW.format(chr(39) + '11:' + chr(39) + ' || ep || ' + chr(39) + ':' + chr(39) + ' || start')} % (n - start) AS goal FROM a", "frames")
def t06(s, d):
    sizes = T.frames(s, d).groupBy("ep").agg(F.count("*").alias("n"))
    return S.nested_draws(sizes, "ep", "n", 11)


@query("s04_seeded_records", "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem ORDER BY md5('3:' || l_orderkey || '-' || l_partkey || '-' || l_linenumber), 1, 2, 3 LIMIT 500")
def s04(s, d):
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_linenumber")
    rows = T.table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return S.seeded_pick(rows.withColumn("__key", key), "__key", 500, 3, "l_orderkey", "l_partkey", "l_linenumber").drop("__key")


@query("s08_seeded_splats", "SELECT id, round(exp(log_scale), 6) AS scale, round(1 / (1 + exp(-opacity_logit)), 6) AS opacity FROM (FROM splats ORDER BY md5('5:' || id), id LIMIT 200)", "splats")
def s08(s, d):
    picked = S.seeded_pick(T.splats(s, d), "id", 200, 5)
    return picked.select("id", r(F.exp("log_scale")).alias("scale"), r(1 / (1 + F.exp(-c("opacity_logit")))).alias("opacity"))


@query("w12_chaikin_rounds", None)
def w12(s, d):
    """Two rounds over routes; held against a plain loop in the tests."""
    return S.chaikin_rounds(T.frames(s, d).select("ep", "frame", "x", "z"), 2)
