"""Domain tables made from the driver's tables, as DataFrames and as the same CTEs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.grid import cell, decode, z_up_to_y_down
from ..operators.sequences import offsets


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def points(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as fixed-point records, decoded and turned to world axes: x, y (down), z, qty."""
    raw = table(spark, d, "lineitem")
    x, y, z = z_up_to_y_down(decode(F.col("l_partkey").cast("double"), 0.01), decode(F.col("l_suppkey").cast("double"), 0.1), decode(F.col("l_quantity").cast("int").cast("double"), 0.05))
    return raw.select(x.alias("x"), y.alias("y"), z.alias("z"), "l_orderkey", "l_tax", "l_discount")


#: Cells of 0.1 m from the origin to the points' greatest coordinates, as SQL on points.
GRID = "spec AS (SELECT CAST(max(floor(x / 0.1::DOUBLE)) AS BIGINT) + 1 AS w, CAST(max(floor(z / 0.1::DOUBLE)) AS BIGINT) + 1 AS h FROM points), grid AS (SELECT i, j FROM (SELECT unnest(range(w)) AS i FROM spec), (SELECT unnest(range(h)) AS j FROM spec))"


def extent(spark: SparkSession, d: str) -> tuple[int, int]:
    """Width and height of that grid, from the points' bounds; one cell where there are no points."""
    at = points(spark, d).agg(F.max(cell(F.col("x"), 0.0, 0.1)).alias("w"), F.max(cell(F.col("z"), 0.0, 0.1)).alias("h")).first()
    return (at.w or 0) + 1, (at.h or 0) + 1


def frames(spark: SparkSession, d: str) -> DataFrame:
    """events as episodes: ep, frame, x, z."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select(F.col("user_id").alias("ep"), (F.row_number().over(w) - 1).cast("bigint").alias("frame"), F.col("value").alias("x"), (F.col("event_id") % 97).cast("double").alias("z"), "event_id", "event_type", "props")


def poses(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as two matrices of 16 doubles."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    return e.select("vec_id", "label", F.slice("e", 1, 16).alias("a"), F.slice("e", 17, 16).alias("b"))


def depths(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as depth images: frame, pos, metres."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame"), F.posexplode("embedding").alias("pos", "v"))
    return e.select("frame", F.col("pos").cast("bigint").alias("pos"), (F.abs(F.col("v").cast("double")) * 12.0).alias("metres"))


def routes(spark: SparkSession, d: str) -> DataFrame:
    """orders as a trajectory manifest: id, length, seed, status."""
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 10000.0).alias("length"), F.col("o_custkey").alias("seed"), F.col("o_orderstatus").alias("status"))


def geometry(spark: SparkSession, d: str) -> DataFrame:
    """documents as geometry records of three batches: part 0 history, 1 base, 2 candidate."""
    return table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 3).alias("part"), F.sha2("text", 256).alias("h"))


def splats(spark: SparkSession, d: str) -> DataFrame:
    """part as Gaussians: id, x, z, log scale, opacity logit."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 0.2).alias("x"), (F.col("p_retailprice") / 100.0).alias("z"), F.ln(F.col("p_size") / 10.0).alias("log_scale"), ((F.col("p_retailprice") - 1200.0) / 150.0).alias("opacity_logit"))


def rigid(spark: SparkSession, d: str) -> DataFrame:
    """events as robot poses: ep, frame, x, z, and the unit vector (fx, fz) of its heading."""
    yaw = F.radians(F.col("event_id") % 360)
    return frames(spark, d).select("ep", "frame", "x", "z", F.cos(yaw).alias("fx"), F.sin(yaw).alias("fz"))


def ranges(spark: SparkSession, d: str) -> DataFrame:
    """events as episode ranges that cover all frames: ep, first, last."""
    sizes = table(spark, d, "events").groupBy(F.col("user_id").alias("ep")).agg(F.count("*").alias("n"))
    return offsets(sizes, "ep", "n").select("ep", F.col("start").cast("bigint").alias("first"), (F.col("start") + F.col("n") - 1).cast("bigint").alias("last"))


CTES = {
    "rigid": "rigid AS (SELECT ep, frame, x, z, cos(radians(event_id % 360)) AS fx, sin(radians(event_id % 360)) AS fz FROM frames)",
    "ranges": "ranges AS (SELECT ep, CAST(sum(n) OVER (ORDER BY ep) - n AS BIGINT) AS first, CAST(sum(n) OVER (ORDER BY ep) - 1 AS BIGINT) AS last FROM (SELECT user_id AS ep, count(*) AS n FROM events GROUP BY 1))",
    "points": "points AS (SELECT l_partkey * 0.01::DOUBLE + 0.0::DOUBLE AS x, -(CAST(trunc(l_quantity) AS DOUBLE) * 0.05::DOUBLE) AS y, l_suppkey * 0.1::DOUBLE AS z, l_orderkey, l_tax, l_discount FROM lineitem)",
    "frames": "frames AS (SELECT user_id AS ep, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, value AS x, (event_id % 97)::DOUBLE AS z, event_id, event_type, props FROM events)",
    "poses": "poses AS (SELECT vec_id, label, embedding[1:16]::DOUBLE[] AS a, embedding[17:32]::DOUBLE[] AS b FROM embeddings)",
    "depths": "depths AS (SELECT vec_id AS frame, k - 1 AS pos, abs(embedding[k]::DOUBLE) * 12.0::DOUBLE AS metres FROM embeddings, range(1, 65) r(k))",
    "routes": "routes AS (SELECT o_orderkey AS id, o_totalprice / 10000.0::DOUBLE AS length, o_custkey AS seed, o_orderstatus AS status FROM orders)",
    "geometry": "geometry AS (SELECT doc_id, doc_id % 3 AS part, sha256(text) AS h FROM documents)",
    "splats": "splats AS (SELECT p_partkey AS id, p_size * 0.2::DOUBLE AS x, p_retailprice / 100.0::DOUBLE AS z, ln(p_size / 10.0::DOUBLE) AS log_scale, (p_retailprice - 1200.0::DOUBLE) / 150.0::DOUBLE AS opacity_logit FROM part)",
}


def with_(*names: str) -> str:
    return "WITH " + ", ".join(CTES[n] for n in names) + " "
