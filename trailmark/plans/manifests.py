"""Queries on manifests, routes, ranges, checkpoints and their verdicts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import grid, numeric, text
from ..operators import matching as M
from ..operators import sequences as S
from . import carriers as T
from .registry import c, query, r

#: Ordered prefixes and their groups; the first that fits counts.
PREFIXES = [("ECONOMY", "core"), ("STANDARD", "core"), ("PROMO", "frozen"), ("SMALL", "head")]

_GROUP = "CASE WHEN starts_with(p_type, 'ECONOMY') THEN 'core' WHEN starts_with(p_type, 'STANDARD') THEN 'core' WHEN starts_with(p_type, 'PROMO') THEN 'frozen' WHEN starts_with(p_type, 'SMALL') THEN 'head' ELSE 'other' END"


@query("p38_prefix_groups", f"SELECT {_GROUP} AS kind, count(*) AS n FROM part GROUP BY 1")
def p38(s, d):
    return T.table(s, d, "part").groupBy(text.prefix_group(c("p_type"), PREFIXES, "other").alias("kind")).agg(F.count("*").alias("n"))


@query("p40_terminated_strings", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_name || '  x' WHEN 2 THEN '' ELSE p_brand END AS brand FROM part")
def p40(s, d):
    """Ended by a NUL after spaces, with spaces inside, at once, or not at all."""
    k = c("p_partkey") % 4
    raw = F.when(k == 0, F.concat("p_brand", F.lit(" \0rest\0"))).when(k == 1, F.concat("p_name", F.lit("  x\0"))).when(k == 2, F.concat(F.lit("\0"), "p_brand")).otherwise(c("p_brand"))
    return T.table(s, d, "part").select("p_partkey", text.terminated(raw).alias("brand"))


@query("s09_even_sample", "SELECT l.* FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders) l JOIN (SELECT DISTINCT CAST(floor(t * ((SELECT count(*) FROM orders) - 1) / 99.0::DOUBLE) AS BIGINT) AS k FROM range(0, 100) q(t)) USING (k)")
def s09(s, d):
    return S.evenly_spaced(T.table(s, d, "orders").select("o_orderkey"), "o_orderkey", 100).select("o_orderkey", "k")


@query("s10_episode_scan", "SELECT event_id, user_id, event_type, value, props FROM events")
def s10(s, d):
    return T.table(s, d, "events").select("event_id", "user_id", "event_type", "value", "props")


@query("s11_projected_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 45")
def s11(s, d):
    return T.table(s, d, "lineitem").where("l_quantity >= 45").select("l_orderkey", "l_quantity")


@query("s14_first_seen_paths", "SELECT o_orderpriority AS path, min(o_orderkey) AS pos FROM orders GROUP BY 1")
def s14(s, d):
    return S.first_seen(T.table(s, d, "orders").select(c("o_orderpriority").alias("path"), c("o_orderkey").alias("pos")), "path", "pos")


@query("s16_json_lines", "SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def s16(s, d):
    return T.table(s, d, "events").groupBy("user_id").agg(F.sum(F.from_json("props", "k bigint")["k"]).alias("k"))


@query("s19_dotted_lookup", "SELECT event_id, CAST(json_extract_string('{\"a\": {\"b\": ' || props || '}}', '$.a.b.k') AS BIGINT) AS k FROM events")
def s19(s, d):
    nested = F.concat(F.lit('{"a": {"b": '), c("props"), F.lit("}}"))
    return T.table(s, d, "events").select("event_id", text.dotted(nested, "a.b.k").cast("bigint").alias("k"))


@query("s25_latest_values", "SELECT event_type, max_by(value, (ts, event_id)) AS value, count(*) AS n FROM events GROUP BY 1")
def s25(s, d):
    return T.table(s, d, "events").groupBy("event_type").agg(F.max(F.struct("ts", "event_id", "value"))["value"].alias("value"), F.count("*").alias("n"))


@query("f05_finite_rows", "SELECT count(*) AS n, count(*) FILTER (isfinite(value) AND isfinite(ln(value - 5))) AS finite FROM (SELECT greatest(value, 5.0001) AS value FROM events)")
def f05(s, d):
    v = F.greatest(c("value"), F.lit(5.0001))
    return T.table(s, d, "events").agg(F.count("*").alias("n"), F.count_if(grid.finite(v) & grid.finite(F.ln(v - 5))).alias("finite"))


@query("f12_stale_artifacts", "SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE NOT (o_orderstatus = 'F' AND o_custkey % 25 = c_nationkey)")
def f12(s, d):
    o = T.table(s, d, "orders").join(T.table(s, d, "customer"), c("o_custkey") == c("c_custkey"))
    return o.where(M.stale({"o_orderstatus": F.lit("F"), "o_custkey % 25": c("c_nationkey")})).select("o_orderkey")


@query("f13_endpoint_reasons", "SELECT id, CASE WHEN EXISTS (SELECT 1 FROM splats b WHERE b.id < a.id AND (a.x - b.x) * (a.x - b.x) + (a.z - b.z) * (a.z - b.z) <= 0.0025) THEN 'too close' WHEN x < 1 THEN 'outside' ELSE 'accepted' END AS reason FROM splats a", "splats")
def f13(s, d):
    g = M.least_within(T.splats(s, d), 0.05, "id")
    return g.select("id", F.when(c("least") < c("id"), "too close").when(c("x") < 1, "outside").otherwise("accepted").alias("reason"))


@query("f14_record_reasons", "SELECT id, CASE WHEN NOT isfinite(length) THEN 'not finite' WHEN length < 5 THEN 'too short' WHEN length > 50 THEN 'too long' WHEN status = 'P' THEN 'collision' WHEN seed % 10 = 0 THEN 'count mismatch' END AS reason FROM routes", "routes")
def f14(s, d):
    reason = F.when(~grid.finite(c("length")), "not finite").when(c("length") < 5, "too short").when(c("length") > 50, "too long").when(c("status") == "P", "collision").when(c("seed") % 10 == 0, "count mismatch")
    return T.routes(s, d).select("id", reason.alias("reason"))


@query("j04_manifest_files", "SELECT count(*) AS entries, count(c_custkey) AS matched, count(*) = count(c_custkey) AS complete FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def j04(s, d):
    got = M.matched(T.table(s, d, "orders"), T.table(s, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return got.select("entries", "matched", "complete")


@query("j14_bound_hashes", "SELECT a.doc_id AS scene, count(*) AS bound FROM geometry a JOIN geometry b USING (h) WHERE a.part = 0 GROUP BY 1", "geometry")
def j14(s, d):
    g = T.geometry(s, d)
    sizes = g.groupBy("h").agg(F.count("*").alias("bound"))
    return g.where("part = 0").join(sizes, "h").select(c("doc_id").alias("scene"), "bound")


@query("a16_seed_counts", "SELECT seed % 20 AS seed, count(*) AS n FROM routes GROUP BY 1", "routes")
def a16(s, d):
    return T.routes(s, d).groupBy((c("seed") % 20).alias("seed")).agg(F.count("*").alias("n"))


@query("a25_run_means", "SELECT status, round(avg(length), 6) AS length, round(avg(seed), 6) AS seed, round(avg(CAST(length > 25 AS INTEGER)), 6) AS flagged FROM routes GROUP BY 1", "routes")
def a25(s, d):
    return T.routes(s, d).groupBy("status").agg(r(F.avg("length")).alias("length"), r(F.avg("seed")).alias("seed"), r(F.avg((c("length") > 25).cast("int"))).alias("flagged"))


@query("a26_distinct_visible", "SELECT l_suppkey AS camera, count(DISTINCT l_partkey) AS visible FROM lineitem GROUP BY 1")
def a26(s, d):
    return T.table(s, d, "lineitem").groupBy(c("l_suppkey").alias("camera")).agg(F.countDistinct("l_partkey").alias("visible"))


@query("w05_contiguous_cover", "SELECT bool_and(first = coalesce(before + 1, 0)) AS covered, max(last) + 1 AS n FROM (SELECT *, lag(last) OVER (ORDER BY first) AS before FROM ranges)", "ranges")
def w05(s, d):
    return S.covered(T.ranges(s, d)).select("covered", "n")


@query("w09_first_occurrence", "SELECT doc_id, h FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS k FROM geometry) WHERE k = 1", "geometry")
def w09(s, d):
    return S.first_seen(T.geometry(s, d), "h", "doc_id").select("doc_id", "h")


@query("w10_target_count", "SELECT id, length FROM routes WHERE length BETWEEN 5 AND 50 ORDER BY id LIMIT 100", "routes")
def w10(s, d):
    return T.routes(s, d).where(c("length").between(5, 50)).orderBy("id").limit(100).select("id", "length")


@query("w15_ordinal_names", "SELECT id, row_number() OVER (ORDER BY id) - 1 AS ordinal, 'episode_' || lpad(CAST(row_number() OVER (ORDER BY id) - 1 AS VARCHAR), 6, '0') AS name FROM routes", "routes")
def w15(s, d):
    return S.ordinals(T.routes(s, d).select("id"), "id").select("id", "ordinal", F.concat(F.lit("episode_"), F.lpad(c("ordinal").cast("string"), 6, "0")).alias("name"))


@query("t01_order_ranks", "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_type, p_size, p_partkey) AS k FROM part")
def t01(s, d):
    w = Window.partitionBy("p_brand").orderBy("p_type", "p_size", "p_partkey")
    return T.table(s, d, "part").select("p_partkey", F.row_number().over(w).cast("bigint").alias("k"))


@query("t03_far_enough", "SELECT id FROM routes WHERE length >= 40 OR (length = (SELECT max(length) FROM routes) AND NOT EXISTS (SELECT 1 FROM routes WHERE length >= 40))", "routes")
def t03(s, d):
    return M.at_least_or_best(T.routes(s, d), "length", 40.0).select("id")


@query("t04_seeded_pick", "SELECT id, length FROM routes ORDER BY md5('7:' || id), id LIMIT 1", "routes")
def t04(s, d):
    return S.seeded_pick(T.routes(s, d).select("id", "length"), "id", 1, 7)


@query("t05_seeded_choice", "SELECT id, length FROM routes ORDER BY md5('7:' || id), id LIMIT 50", "routes")
def t05(s, d):
    return S.seeded_pick(T.routes(s, d).select("id", "length"), "id", 50, 7).orderBy("id")


@query("t07_stream_limit", "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_partkey, l_linenumber LIMIT 1000")
def t07(s, d):
    return T.table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").orderBy("l_orderkey", "l_partkey", "l_linenumber").limit(1000)


@query("t08_natural_order", "SELECT p_partkey, dense_rank() OVER (ORDER BY CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER)) AS k FROM part")
def t08(s, d):
    p = T.table(s, d, "part")
    brands = p.select("p_brand").distinct()  # ranked apart: few rows, so the single-partition window is small
    ranks = brands.withColumn("k", F.dense_rank().over(Window.orderBy(text.number_at_end(c("p_brand")))).cast("bigint"))
    return p.join(ranks, "p_brand").select("p_partkey", "k")


@query("u02_union_of_batches", "SELECT 'a' AS batch, o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'b', o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def u02(s, d):
    o = T.table(s, d, "orders")
    part = lambda name, status: o.where(c("o_orderstatus") == status).select(F.lit(name).alias("batch"), c("o_orderkey").alias("id"))
    return part("a", "F").unionByName(part("b", "O"))


@query("u03_missing_keys", "SELECT p_retailprice AS k FROM part WHERE p_size < 10 EXCEPT SELECT p_retailprice FROM part WHERE p_brand = 'Brand#1'")
def u03(s, d):
    p = T.table(s, d, "part")
    return p.where("p_size < 10").select(c("p_retailprice").alias("k")).subtract(p.where("p_brand = 'Brand#1'").select("p_retailprice"))


@query("u04_shared_keys", "SELECT h FROM geometry WHERE part = 0 INTERSECT SELECT h FROM geometry WHERE part = 1", "geometry")
def u04(s, d):
    g = T.geometry(s, d)
    return g.where("part = 0").select("h").intersect(g.where("part = 1").select("h"))


@query("u06_unanimity", "SELECT conv_id, count(DISTINCT role) = 1 AS unanimous FROM conversations GROUP BY 1")
def u06(s, d):
    return T.table(s, d, "conversations").groupBy("conv_id").agg((F.countDistinct("role") == 1).alias("unanimous"))


_NAMES = "SELECT ep, first, last, last - first + 1 AS n FROM ranges"


@query("v04_metadata_checks", "SELECT user_id AS ep, user_id % 9 <> 4 AS rows_match, user_id % 6 <> 1 AS range_matches FROM events GROUP BY 1", "frames", "ranges")
def v04(s, d):
    """Declared counts and ranges against the frames; the counts of some episodes and the ranges of others are wrong."""
    n = T.frames(s, d).groupBy("ep").agg(F.count("*").alias("n"), F.max("frame").alias("top"))
    told = T.ranges(s, d).withColumn("told", c("last") - c("first") + 1 + F.when(c("ep") % 9 == 4, 1).otherwise(0))
    told = told.withColumn("last", c("last") - F.when(c("ep") % 6 == 1, 1).otherwise(0))
    return told.join(n, "ep").select("ep", (c("told") == c("n")).alias("rows_match"), (c("last") - c("first") == c("top")).alias("range_matches"))


@query("v05_camera_binding", "SELECT o_orderkey AS id, o_custkey IS NOT DISTINCT FROM c_custkey AND o_custkey % 25 IS NOT DISTINCT FROM c_nationkey AS bound FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def v05(s, d):
    o = T.table(s, d, "orders").join(T.table(s, d, "customer"), c("o_custkey") == c("c_custkey"), "left")
    return o.select(c("o_orderkey").alias("id"), (~M.stale({"o_custkey": c("c_custkey"), "o_custkey % 25": c("c_nationkey")})).alias("bound"))


@query("v06_stage_status", "SELECT o_orderkey AS id, CASE WHEN l.k IS NOT NULL AND c_custkey IS NOT NULL THEN 'rendered' WHEN c_custkey IS NOT NULL THEN 'camera' ELSE 'pending' END AS status FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') l ON l.k = o_orderkey")
def v06(s, d):
    ids = T.table(s, d, "orders").select(c("o_orderkey").alias("id"), "o_custkey")
    camera = ids.join(T.table(s, d, "customer").where("c_acctbal > 0"), c("o_custkey") == c("c_custkey"), "left_semi").select("id")
    rendered = T.table(s, d, "lineitem").where("l_returnflag = 'R'").select(c("l_orderkey").alias("id"))
    return M.stage_status(ids.select("id"), camera, rendered)


@query("v08_batch_load", "SELECT (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)) AS repeated, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans")
def v08(s, d):
    li, o = T.table(s, d, "lineitem"), T.table(s, d, "orders")
    repeated = li.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("repeated"))
    orphans = li.select("l_orderkey").distinct().join(o, c("l_orderkey") == c("o_orderkey"), "left_anti").agg(F.count("*").alias("orphans"))
    return o.agg(F.count("*").alias("n")).crossJoin(repeated).crossJoin(orphans)


@query("v09_layer_shapes", "SELECT label, count(*) AS layers, min(len(embedding)) = max(len(embedding)) AS same_shape, bool_and(list_bool_and(list_transform(embedding, lambda v: isfinite(v)))) AS finite FROM embeddings GROUP BY 1")
def v09(s, d):
    e = c("embedding")
    return T.table(s, d, "embeddings").groupBy("label").agg(F.count("*").alias("layers"), (F.min(F.size(e)) == F.max(F.size(e))).alias("same_shape"), F.bool_and(F.forall(e, grid.finite)).alias("finite"))


@query("k10_global_names", "SELECT f.ep, f.frame, q.first + f.frame AS idx, lpad(CAST(q.first + f.frame AS VARCHAR), 8, '0') || '.jpg' AS name FROM frames f JOIN ranges q USING (ep)", "frames", "ranges")
def k10(s, d):
    at = (c("first") + c("frame")).alias("idx")
    named = T.frames(s, d).join(T.ranges(s, d), "ep").select("ep", "frame", at)
    return named.withColumn("name", F.concat(F.lpad(c("idx").cast("string"), 8, "0"), F.lit(".jpg")))


@query("k14_depth_statistics", "SELECT frame, round(min(metres), 6) AS least, round(max(metres), 6) AS greatest, round(avg(metres), 6) AS mean, count(*) AS n FROM depths GROUP BY 1", "depths")
def k14(s, d):
    m = c("metres")
    return T.depths(s, d).groupBy("frame").agg(r(F.min(m)).alias("least"), r(F.max(m)).alias("greatest"), r(F.avg(m)).alias("mean"), F.count("*").alias("n"))


@query("m09_hash_agreement", "WITH g AS (SELECT doc_id % 3 AS part, sha256(text) AS e, sha256(translate(text, 'ERST', 'erst')) AS q FROM documents) SELECT count(*) FILTER ((e IN (SELECT e FROM g WHERE part = 0)) <> (q IN (SELECT q FROM g WHERE part = 0))) AS disagreements, count(*) AS n FROM g WHERE part = 2")
def m09(s, d):
    g = T.table(s, d, "documents").select((c("doc_id") % 3).alias("part"), F.sha2("text", 256).alias("e"), F.sha2(F.translate("text", "ERST", "erst"), 256).alias("q"))
    return M.agreement(g.where("part = 2"), g.where("part = 0"), "e", "q")


@query("x01_control_tick", "SELECT event_id, least(20.0::DOUBLE, greatest(-20.0::DOUBLE, 0.5::DOUBLE * (value - 60) - 0.1::DOUBLE * (event_id % 13))) AS torque FROM events")
def x01(s, d):
    return T.table(s, d, "events").select("event_id", numeric.clamped_torque(F.lit(0.5), F.lit(0.1), c("value") - 60, c("event_id") % 13, F.lit(20.0)).alias("torque"))
