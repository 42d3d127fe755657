"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame operations only.

A paragraph is a line with the line ends after it; a longer line is cut every PARAGRAPH code points.  The sketch of a text in a size m has
three sub-tables of m cells; each digest adds one to the count of its cell in each, and itself and its check to the cell's sums, so
repeated paragraphs count as often as they occur.  A cell's place in a sub-table is a hash modulo m, a power of two, so a sketch
folds to any smaller size by adding cells up; the returned one has the size that the text's own paragraphs ask for.

Two texts are compared in the size that an estimate of their difference asks for (from a sample of their digests), at least the larger of their
own.  Each is sketched in that size, the sketches are subtracted cell by cell, and peeling takes digests from cells that hold one digest only, a
sub-table at a time, until no cell is left; it gives them with their copies, negative for the other text's.
Where cells are left, both are sketched again in a larger size with other hashes.

Rows meet their neighbour by a window over ranges of identifiers; each range also gets the first row of the next range.
Digests and cells are written as tables bucketed by a row's number, of some megabytes of text each, so that sums, peeling, joins and retries need no shuffle.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stage

PARAGRAPH, ROWS_PER_RANGE, SIDE, BUCKET_BYTES = 120, 1000, 256, 6 << 20
#: Cells of a sub-table for each paragraph of a text, and for each digest that two texts are thought to differ in.
OWN, DIFFERING = 0.5, 0.8
#: By attempt: times the cells, and peeled sub-tables.
ATTEMPTS = ((1, 9), (4, 9), (16, 12), (64, 12), (256, 24))
#: Peeled sub-tables between two writes; digests of which one in SAMPLED is looked at to estimate a difference.
STEPS, SAMPLED = 3, 8
LEAST = -(2**63)


def digests(text: Column) -> Column:
    """32-bit digests of a text's paragraphs, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PARAGRAPH}}}\n*|\n+"), F.lit(0)), lambda p: F.shiftright(F.xxhash64(p), 32).cast("int"))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """The number of bounds at or below a key, by two short searches."""
    if not bounds:
        return F.lit(0)
    rows = [bounds[i : i + SIDE] for i in range(0, len(bounds), SIDE)]
    table = F.array(*[F.array(*[F.lit(b) for b in row]) for row in rows]) if len(bounds) <= 64 else F.from_json(F.lit(str(rows)), "array<array<bigint>>")
    first = F.size(F.filter(F.transform(table, lambda r: r[0]), lambda b: b <= key))
    row = F.element_at(table, F.greatest(first, F.lit(1)))
    return F.when(first == 0, 0).otherwise((first - 1) * SIDE + F.size(F.filter(row, lambda b: b <= key)))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with range, rn (its place there) and next_text, of the next row in descending doc_id; after the last comes the first.

    Rows of one identifier are ordered by a hash of the text, then the text; null identifiers come last.
    """
    docs = docs.withColumn("key", F.coalesce("doc_id", F.lit(LEAST)))
    ids = docs.select("key")
    n = ids.count()
    ranges = max(1, min(SIDE * SIDE, math.ceil(n / ROWS_PER_RANGE)))
    bounds = ids.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], max(10_000, 20 * ranges))).first()[0] if ranges > 1 else []
    bounds = sorted(set(bounds or []))
    placed = docs.withColumn("range", _range_of(F.col("key"), bounds))
    tops = sorted(placed.groupBy("range").agg(F.max("key").alias("top")).collect())  # no more rows than ranges
    goes = {r.top: tops[(k + 1) % len(tops)].range for k, r in enumerate(tops)}
    guards = []
    if tops:
        where = docs.sparkSession.createDataFrame([(k, r) for k, r in goes.items()], "key long, range int")
        guards = [docs.join(F.broadcast(where), "key").withColumn("guard", F.lit(1))]
    rows = placed.withColumn("guard", F.lit(0))
    for g in guards:
        rows = rows.unionByName(g)
    order = Window.partitionBy("range").orderBy("guard", F.desc("key"), F.xxhash64("text"), "text")
    return rows.select("range", "guard", "doc_id", "text", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next_text")).where("guard = 0").drop("guard")


def _position(key: str, sub: str, seed: int) -> str:
    return f"pmod(xxhash64({key}, {sub}, {seed}), m)"


def _check(key: str, seed: int) -> str:
    return f"shiftright(xxhash64({key}, {seed + 1000}), 32)"


def _power(cells: str) -> str:
    """The power of two at or above a number of cells, 4 at least."""
    return f"cast(greatest(4, power(2, ceil(log2(greatest(1, {cells}))))) as int)"


def _sketch(items: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """The cells (keys, cell, c, k, q) that hold something, of items (keys with m, key)."""
    put = ", ".join(f"{s} * m + {_position('key', str(s), seed)}" for s in range(3))
    cells = items.select(*keys, "key", F.expr(_check("key", seed)).alias("chk"), F.expr(f"explode(array({put}))").alias("cell"))
    return cells.groupBy(*keys, "cell").agg(F.count("*").alias("c"), F.sum("key").alias("k"), F.sum("chk").alias("q"))


def sketches(table: DataFrame, columns: list[str]) -> DataFrame:
    """Per id with any digest: the sketch of each array named in its own size, as text, null if it is empty.

    Cells of a sub-table, then each cell that holds something: its number, count, sum and check sum in hexadecimal.
    """
    keys = ["id", "side", "m"]
    items = table.select("id", F.posexplode(F.array(*columns)).alias("side", "own"))
    items = items.select("id", "side", F.expr(_power(f"{OWN} * size(own)")).alias("m"), F.explode("own").alias("key"))
    cells = _sketch(items.withColumn("key", F.col("key").cast("long")), keys, 0)
    text = "struct(cell, m, concat_ws('.', hex(cell), hex(c), hex(k), hex(q)) as t)"
    lists = [F.array_sort(F.collect_list(F.expr(f"if(side = {n}, {text}, null)"))).alias(f"s{n}") for n in range(len(columns))]
    whole = [F.expr(f"if(size(s{n}) > 0, concat(hex(s{n}[0].m), ':', array_join(transform(s{n}, x -> x.t), '-')), null) as s{n}") for n in range(len(columns))]
    return cells.groupBy("id").agg(*lists).select("id", *whole)


#: A digest that was taken is kept as a cell below 0.
_TAKEN = "(-1 - own - 2147483648)"
_DIGEST = "cast(-1 - cell - 2147483648 as int)"
_KEYS = ["id", "pair", "m"]


def _estimate(a: str, b: str) -> str:
    """In how many digests two arrays are thought to differ: all of the smaller ones, or by a sample."""
    sample = lambda x: f"filter({x}, d -> pmod(d, {SAMPLED}) = 0)"
    found = f"size(array_except({sample(a)}, {sample(b)})) + size(array_except({sample(b)}, {sample(a)}))"
    return f"least(size({a}) + size({b}), {1.25 * SAMPLED} * ({found}) + 16)"


def _subtracted(table: DataFrame, left: str, right: list[str], times: int, seed: int) -> DataFrame:
    """Per (id, pair): the cells of the sketch of left minus that of each array of right, without those that hold nothing."""
    own = ", ".join(f"{OWN} * size({x})" for x in (left, *right))
    differing = ", ".join(f"{DIFFERING} * ({_estimate(left, x)})" for x in right)
    sized = table.withColumn("m", F.expr(f"{times} * {_power(f'greatest({own}, {differing})')}"))
    items = sized.select("id", "m", "wanted", F.posexplode(F.array(left, *right)).alias("side", "own")).where("side = 0 or wanted is null or array_contains(wanted, side - 1)")
    items = items.select("id", "m", "wanted", "side", F.explode("own").alias("key")).withColumn("key", F.col("key").cast("long"))
    cells = _sketch(items, ["id", "m", "wanted", "side"], seed)
    pairs = f"if(side = 0, transform(filter(sequence(0, {len(right) - 1}), p -> wanted is null or array_contains(wanted, p)), p -> struct(p as pair, 1 as sign)), array(struct(side - 1 as pair, -1 as sign)))"
    cells = cells.select("id", "m", "cell", "c", "k", "q", F.explode(F.expr(pairs)).alias("p"))
    return _summed(cells.select("id", "p.pair", "m", "cell", *[(F.col(x) * F.col("p.sign")).alias(x) for x in "ckq"]))


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*_KEYS, "cell").agg(F.sum("c").alias("c"), F.sum("k").alias("k"), F.sum("q").alias("q")).where("c <> 0 or k <> 0 or q <> 0")


def _peeled(cells: DataFrame, first: int, rounds: int, seed: int) -> DataFrame:
    """Cells after so many more rounds; round r takes the digests that are alone in a cell of sub-table r mod 3."""
    for r in range(first, first + rounds):
        s = r % 3
        cells = cells.withColumn("own", F.expr("k div nullif(c, 0)"))
        pure = f"cell >= 0 and cell div m = {s} and c <> 0 and own * c = k and own between -2147483648 and 2147483647 and {_check('own', seed)} * c = q and {s} * m + {_position('own', str(s), seed)} = cell"
        others = ", ".join(f"struct({o} * m + {_position('own', str(o), seed)} as cell, -c as c, -k as k, -q as q)" for o in range(3) if o != s)
        step = f"explode(if({pure}, array(struct({_TAKEN} as cell, c, 0L as k, 0L as q), {others}), array(struct(cell, c, k, q))))"
        cells = _summed(cells.select(*_KEYS, F.expr(step).alias("x")).select(*_KEYS, "x.*"))
    return cells


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """df written to the shared folder in buckets by id, and read back; its name in the catalogue is gone at once."""
    spark = df.sparkSession
    name = f"trailmark_{uuid.uuid4().hex}"
    path = stage.new_path(spark, "buckets")
    df.write.bucketBy(buckets, "id").option("path", path).option("compression", "zstd").saveAsTable(name)
    out = spark.table(name)
    out.schema  # resolved while the name is there
    spark.sql(f"DROP TABLE {name}")
    out.written_path = path
    stage.collect_shuffles(spark)
    return out


def differences(table: DataFrame, left: str, right: list[str], buckets: int) -> list[DataFrame]:
    """For rows of a table bucketed by id (id, arrays of digests) and each array named in right, by attempt: id, pair (its place), found.

    found has the digests of which one of the two has more, in order, and how many more: above 0 for left, below for right;
    pairs without any are left out.  Pairs that no size could peel are an error: that takes different digests with the same places in five sizes.
    """
    spark = table.sparkSession
    out, todo = [], table.withColumn("wanted", F.lit(None).cast("array<int>"))
    found = F.array_sort(F.collect_list(F.expr(f"if(cell < 0, struct({_DIGEST} as digest, cast(c as int) as copies), null)")))
    for seed, (times, rounds) in enumerate(ATTEMPTS):
        cells, done = _subtracted(todo, left, right, times, seed), 0
        while done < rounds:
            before = cells
            cells = _bucketed(_peeled(cells, done, min(STEPS, rounds - done), seed), buckets)
            if done:
                stage.discard(before)
            done += STEPS
            if not cells.where("cell >= 0").limit(1).count():
                break
        stuck = cells.where("cell >= 0").select("id", "pair").distinct()
        got = cells.groupBy("id", "pair").agg(found.alias("found"), F.count_if(F.col("cell") >= 0).alias("stuck")).where("stuck = 0").drop("stuck")
        out.append(got)
        stuck = _bucketed(stuck.groupBy("id").agg(F.array_sort(F.collect_list("pair")).alias("wanted")), buckets)
        if not stuck.limit(1).count():
            return out
        todo = table.join(stuck, "id")
    raise ValueError(f"sketches of {spark.createDataFrame(stuck.limit(1).collect(), stuck.schema).first()} can't be peeled")


def _likeness(a: str, b: str, d: str) -> Column:
    """Shared paragraphs over all, copies counted; two empty texts are alike."""
    return F.expr(f"if(size({a}) + size({b}) = 0, 1D, (size({a}) + size({b}) - {d}) / cast(size({a}) + size({b}) + {d} as double))")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_differs, next_differs.

    The last two are the paragraphs' digests recovered from the subtracted sketches, with their copies: above 0 where the text has
    more of them, below 0 where the other has.

    The edited text has its last third of code points (rounded down) replaced by the first as many, or all, of the next row's text.
    Null texts are empty; repeated rows and identifiers are rows of their own; the only row of a table is its own next.
    An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, min(20_000, math.ceil(size / BUCKET_BYTES)))
    rows = with_next(rows).withColumn("id", F.expr("shiftleft(cast(range as bigint), 32) + rn")).withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)), substring(next_text, 1, cast(n_chars div 3 as int)))"))
    made = rows.select("id", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), digests(F.col("next_text")).alias("b"))
    table = _bucketed(made.repartition(buckets, "id"), buckets)
    found = None
    for got in differences(table, "a", ["e", "b"], buckets):
        got = got.groupBy("id").agg(*[F.first(F.expr(f"if(pair = {n}, found, null)"), ignorenulls=True).alias(f"f{n}") for n in (0, 1)])
        found = got if found is None else found.join(got.select("id", *[F.col(f"f{n}").alias(f"g{n}") for n in (0, 1)]), "id", "full").select("id", *[F.coalesce(f"f{n}", f"g{n}").alias(f"f{n}") for n in (0, 1)])
    both = table.join(found, "id", "left").join(sketches(table, ["a", "e"]), "id", "left")
    none = F.expr("cast(array() as array<struct<digest: int, copies: int>>)")
    both = both.withColumns({f"d{n}": F.coalesce(f"f{n}", none) for n in (0, 1)} | {f"s{n}": F.coalesce(f"s{n}", F.lit("4:")) for n in (0, 1)})
    d = [f"aggregate(d{n}, 0L, (s, x) -> s + abs(x.copies))" for n in (0, 1)]
    return both.select("doc_id", "n_chars", "edited_sha256", F.col("s0").alias("fingerprint"), F.col("s1").alias("edited_fingerprint"), _likeness("a", "e", d[0]).alias("near_edited"), _likeness("a", "b", d[1]).alias("near_next"), F.col("d0").alias("edited_differs"), F.col("d1").alias("next_differs"))
