"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has POSITIONS values of 16 bits.  It is split into CHUNKS chunks; two
signatures that differ in at most THRESHOLD positions have, by the pigeonhole
principle, a chunk with at most ERRORS differing positions, so they share one of the
keys that leave ERRORS positions of a chunk out.  All such pairs are found:
4 * 16 keys a text.  At a similarity of exactly 0.75 a link's expected distance is 16 of
64; that it exceeds 31 has a probability of about 2e-5, and far less above 0.75.

Work is on classes of equal shingle sets.  Each key's members are compared by
signature and leave a spanning forest, never all pairs; the forests' components
are candidate clusters, which hold every pair within the threshold.  Within a cluster
full shingle sets confirm links; pairs that are connected already are skipped.

A key or cluster of more than BLOCK members is dealt into blocks, each with the same few hubs, so that members of one
group of copies meet through them.  What that connects is then known everywhere, and only members of different parts
are compared across blocks: a group of copies costs its members, not their square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec
from .graph import Forest, components
from .skew import IdFilter, attach
from .stage import frugal, written

POSITIONS, CHUNKS, ERRORS = 64, 16, 1
WIDTH = POSITIONS // CHUNKS
THRESHOLD = CHUNKS * (ERRORS + 1) - 1
#: Members of a block, shingles of a cluster's block, and members that all blocks of a group share.
BLOCK, BLOCK_SHINGLES, HUBS = 192, 1_000_000, 4
_SEEDS = textvec.mix(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR = (_SEEDS[:POSITIONS] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]
_ODD = ((_SEEDS[POSITIONS:] & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1))[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of POSITIONS minima; shingles must not be empty."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
    least = np.full(POSITIONS, 0xFFFFFFFF, np.uint32)
    for a in range(0, short.shape[1], 4096):
        np.minimum(least, ((short[:, a : a + 4096] ^ _XOR) * _ODD).min(axis=1), out=least)
    return (least & np.uint32(0xFFFF)).astype(np.uint16)


def _set_digest(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh128_digest(shingles.tobytes())


def _features(size: int):
    def task(batches):
        for batch in batches:
            words, first = textvec.word_hashes(*textvec.utf8(batch.column(1)))
            counts, digests, signatures = [], [], []
            for shingles in textvec.shingle_sets(words, first, size):
                counts.append(len(shingles))
                digests.append(_set_digest(shingles) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())], names=["doc_id", "n", "digest", "sig"])

    return task


def _keys(batches):
    """The keys of each signature: chunk, position left out, and the values that stay."""
    for batch in batches:
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, CHUNKS, WIDTH).astype(np.int64)
        keys = np.empty((len(sigs), CHUNKS * WIDTH), np.int64)
        for c in range(CHUNKS):
            for o in range(WIDTH):
                left = [p for p in range(WIDTH) if p != o]
                keys[:, c * WIDTH + o] = ((c * WIDTH + o) << 48) | (sigs[:, c, left[0]] << 32) | (sigs[:, c, left[1]] << 16) | sigs[:, c, left[2]]
        reps = np.repeat(batch.column(0).to_numpy(), CHUNKS * WIDTH)
        yield pa.record_batch([pa.array(keys.ravel()), pa.array(reps)], names=["key", "rep"])


def _grouped(batches, columns: int):
    """Lists of rows that share the first columns, from sorted batches."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[-1][:columns] != row[:columns]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _may_link(sig: np.ndarray, n: np.ndarray, i: int) -> np.ndarray:
    """Which later members can be linked to member i, by signature distance and by set size."""
    near = (sig[i + 1 :] != sig[i]).sum(axis=1) <= THRESHOLD
    a, b = np.minimum(n[i + 1 :], n[i]), np.maximum(n[i + 1 :], n[i])
    return np.flatnonzero(near & (100 * a >= 75 * b)) + i + 1


def _edges(pairs: list[tuple[int, int]]):
    return pa.record_batch([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, of sorted distinct arrays."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 75 * (len(both) - shared)


def _forest(batches):
    """For each unit of work a spanning forest of its links, without those inside a part that is known.

    Columns: group, unit, part, rep, n, sig and, where links have to be confirmed, shingles.
    """
    out: list[tuple[int, int]] = []
    for rows in _grouped(batches, 2):
        part, rep = [g[2] for g in rows], [g[3] for g in rows]
        n = np.array([g[4] for g in rows])
        sig = np.frombuffer(b"".join(g[5] for g in rows), np.uint16).reshape(-1, POSITIONS)
        sets = [np.frombuffer(g[6], np.uint64) for g in rows] if len(rows[0]) > 6 else None
        forest, first = Forest(), {}
        for i, p in enumerate(part):
            forest.join(first.setdefault(p, i), i)
        for i in range(len(rows) - 1):
            may = _may_link(sig, n, i)
            if sets:
                may = may[np.argsort((sig[may] != sig[i]).sum(axis=1), kind="stable")]
            for j in may.tolist():
                if forest.root(i) != forest.root(j) and (sets is None or similar(sets[i], sets[j])):
                    forest.join(i, j)
                    out.append((rep[i], rep[j]))
        if len(out) > 50_000:
            yield _edges(out)
            out = []
    yield _edges(out)


def _worked(units: DataFrame, by: str, payload: DataFrame) -> DataFrame:
    """Edges (a, b) of units of work (by, unit, part, rep) with each member's payload."""
    rows = units.select(by, F.col("unit").cast("string").alias("unit"), "part", "rep").join(payload, "rep")
    dealt = rows.repartition(by, "unit").sortWithinPartitions(by, "unit")
    return dealt.select(by, "unit", "part", "rep", *payload.columns[1:]).mapInArrow(frugal(_forest), "a long, b long").distinct()


def linked(rows: DataFrame, by: str, sizes: DataFrame, payload: DataFrame) -> DataFrame:
    """(node, component) of what the links inside the groups of rows (by, rep) connect.

    sizes: by and blocks, how many blocks each group is dealt into.  payload: rep, n, sig and, where links have to be
    confirmed, shingles; it is joined to the units of work only.
    """
    rows = written(rows.join(sizes, by).select(by, "rep", "blocks"), "rows")
    large = rows.where("blocks > 1")
    hashes = [F.xxhash64("rep", F.lit(k)) for k in range(HUBS)]
    hubs = written(large.groupBy(by).agg(*[F.min(h).alias(f"hub{k}") for k, h in enumerate(hashes)], F.count("*").alias("members")), "hubs")
    total = large.count()
    hub = F.lit(False)
    for k, h in enumerate(hashes):
        hub = hub | (h == F.col(f"hub{k}"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = attach(large, hubs, by, "members", total).withColumn("unit", F.explode(F.when(hub, F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).otherwise(F.array(own))))
    names = [by, "unit", F.col("rep").alias("part"), "rep"]
    first = rows.where("blocks = 1").withColumn("unit", F.lit(0)).select(*names).unionByName(dealt.select(*names))
    edges = written(_worked(first, by, payload), "links")
    found = written(components(edges), "parts")
    if not total:
        return found
    # Across blocks: the members of groups that still fall into several parts.
    parts = large.select(by, "rep").join(found.select(F.col("node").alias("rep"), F.col("component").alias("part")), "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    parts = written(parts, "parts-of-large")
    counts = parts.groupBy(by, "part").agg(F.count("*").alias("own"))
    half = BLOCK // 2
    plan = counts.groupBy(by).agg(F.count("*").alias("parts"), F.sum(F.when(F.col("own") <= half, F.col("own")).otherwise(0)).alias("small"), F.collect_list(F.when(F.col("own") > half, F.struct("part", F.ceil(F.col("own") / half).cast("int").alias("pieces")))).alias("great"), F.sum("own").alias("members"))
    plan = written(plan.where("parts > 1"), "plan")
    if not plan.limit(1).count():
        return found
    unit = lambda part, piece: F.struct(part.alias("part"), piece.alias("piece"))
    none = F.lit(None).cast("bigint")
    pooled = F.ceil(F.col("small") / half).cast("int")
    units = F.concat(F.when(pooled > 0, F.transform(F.sequence(F.lit(0), pooled - 1), lambda k: unit(none, k))).otherwise(F.array().cast("array<struct<part: bigint, piece: int>>")), F.flatten(F.transform("great", lambda g: F.transform(F.sequence(F.lit(0), g["pieces"] - 1), lambda k: unit(g["part"], k)))))
    plan = plan.select(by, "members", pooled.alias("pooled"), "great", units.alias("units"))
    pieces = F.filter("great", lambda g: g["part"] == F.col("part"))
    mine = F.when(F.size(pieces) > 0, unit(F.col("part"), F.pmod(F.xxhash64("rep"), pieces[0]["pieces"]).cast("int"))).otherwise(unit(none, F.pmod(F.xxhash64("part"), F.col("pooled")).cast("int")))
    placed = attach(parts, plan, by, "members", total).withColumn("mine", mine)
    others = F.filter("units", lambda u: u["part"].isNull() | F.col("mine.part").isNull() | (u["part"] != F.col("mine.part")))
    text = lambda u: F.concat_ws("/", u["part"].cast("string"), u["piece"].cast("string"))
    pairs = placed.select(by, "rep", "part", F.explode(F.transform(others, lambda u: F.concat(F.least(text(u), text(F.col("mine"))), F.lit("|"), F.greatest(text(u), text(F.col("mine")))))).alias("unit"))
    return written(components(edges.unionByName(_worked(pairs, by, payload))), "parts")


def _sets(words, size: int):
    def task(batches):
        wanted = IdFilter(words.value)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keep = np.flatnonzero(wanted.passes(ids))
            if len(keep):
                few = batch.take(pa.array(keep))
                got = [s.tobytes() for s in textvec.shingle_sets(*textvec.word_hashes(*textvec.utf8(few.column(1))), size)]
                yield pa.record_batch([few.column(0), pa.array(got, pa.binary())], names=["rep", "shingles"])

    return task


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Linked are texts whose shingle sets have a similarity of 0.75 or more.  A text without
    words (or null) has an empty set and is its own component.  component_id is the smallest
    identifier reachable.  Rows with a null identifier and words join no component (component_id
    null, kept true).  Repeated rows of one identifier and text are all returned, alike; identifiers
    should be unique, and of different texts under one identifier the links of all count.
    An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    feats = written(docs.mapInArrow(frugal(_features(shingle_words)), "doc_id long, n long, digest binary, sig binary"), "features")
    usable = feats.where("digest is not null and doc_id is not null")
    reps = written(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("sig").alias("sig"), F.count("*").alias("copies")), "classes")

    keys = reps.select("rep", "sig").mapInArrow(frugal(_keys), "key long, rep long")
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = written(keys.join(shared, "key"), "members")
    sizes = members.groupBy("key").agg(F.ceil(F.first("members") / BLOCK).alias("blocks"))
    clusters = linked(members.select("key", "rep"), "key", sizes, reps.select("rep", "n", "sig"))

    sizes = clusters.join(reps.select(F.col("rep").alias("node"), "n"), "node").groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    words = spark.sparkContext.broadcast(IdFilter.build(clusters, "node").words)
    sets = docs.where("doc_id is not null").mapInArrow(frugal(_sets(words, shingle_words)), "rep long, shingles binary")
    sets = reps.select("rep", "n", "sig").join(sets, "rep").where("octet_length(shingles) = 8 * n")
    found = linked(clusters.select("component", F.col("node").alias("rep")), "component", sizes, written(sets.join(clusters.select(F.col("node").alias("rep")), "rep", "left_semi"), "sets"))

    final = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"), "copies")
    final = written(final, "class-components")
    total = feats.count()
    told = attach(usable.select("doc_id", "n", "digest"), final, "digest", "copies", total).select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    rest = feats.where("digest is null or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return told.unionByName(rest)

