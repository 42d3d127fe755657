"""Language-model scoring by a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Each context has a restaurant whose base measure is the root restaurant's prediction; all share that parent.
A context is the word before, whichever it is, so contexts grow with the corpus; first tokens, which have none, are customers of the root.
The root's base measure is continuous, so each of its dishes has one table and unseen words together get the probability of a new table.

Layout: documents become blocks of some megabytes of text with a local vocabulary of word hashes; the counts of
a block's words and (context, word) types go, as arrays cut by ranges of the hash space, to the range's task.  All
types of a word meet there, so the root's customers are known, and the places of each block's types are kept; the tables of a context are
spread over ranges, and each sweep sums them by owners, which are ranges of the contexts' hashes, and sends each range the sums of its own contexts.
Nothing is broadcast but a few totals, and no task holds more than its types.
Each sweep resamples customers of every type met twice or more: one after the other leaves its table and sits down anew by the
Chinese-restaurant rule, as many times as the type has customers.  Types met once have one table always, so sweeps carry only their sums.
Predictions are averaged over the kept samples, sent back to the blocks as arrays in the same order, and summed by document.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec
from .stage import collect_shuffles, discard, frugal, written

BLOCK_BYTES, RANGE_TOKENS, RANGES_PER_OWNER, MERGE_TYPES = 12 << 20, 3_000_000, 4, 1 << 22
THETA, BURN_IN, SAMPLES = 1.0, 1, 3
#: With at least so many types of about as many customers, a move of all of them at once is faster than one after the other.
TOGETHER, _CHUNK = 128, 1 << 16
#: The end of a text, as a word hash.
END = np.uint64(0x5EED_0E0F_7E87_0001)
_TOKENS = "block long, n_tokens long, n_train long, docs binary, nulls binary, held binary, lengths binary, tokens binary, vocab binary, counts binary"
_SLICES = "range int, block long, words binary, total binary, light binary, ctxs binary, type_word binary, type_ctx binary, type_count binary"
#: All types of a range, also those that only held-out rows have; customers and singles (types met once) are of its contexts.
#: blocks, asked_words and asked_types: for each slice its block, and the places of its words and types.
_TYPES = "range int, words binary, total binary, light binary, ctxs binary, type_word binary, type_ctx binary, type_count binary, customers binary, singles binary, totals binary, blocks binary, asked_words array<binary>, asked_types array<binary>"
#: The types of a range met twice or more; served holds the root's customers by word without theirs, fixed what sweeps don't change of the totals.
_STATE = "range int, served binary, fixed binary, ctxs binary, singles binary, type_word binary, type_ctx binary, type_count binary, tables binary, sizes binary, samples array<binary>, totals binary"
#: Numbers of contexts sent to their owner to be summed, and sums sent back to a range that asks.
_SENT = "owner int, range int, ask boolean, keys binary, numbers array<binary>"
_TOLD = "range int, owner int, numbers array<binary>"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _batch(schema: str, rows: list[tuple]):
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "double": pa.float64(), "boolean": pa.bool_()}
    kinds = [types[x.split()[1]] for x in schema.split(", ")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names=_names(schema))


def _squeezed(x: np.ndarray) -> bytes:
    """uint32 numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _packed(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + (_squeezed(x) if len(x) else b"")


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return _unsqueezed(data[8:], n).astype(np.int64) if n else np.zeros(0, np.int64)


def _rising(x: np.ndarray) -> bytes:
    """Numbers that never fall, by their steps."""
    return _packed(np.diff(x, prepend=0))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _blocks(batches):
    """Documents as blocks: places in the block's sorted vocabulary, and training counts of that."""
    from pyspark import TaskContext

    serial = TaskContext.get().partitionId() << 32
    ids, held, raws, sizes, size = [], [], [], [], 0

    def block():
        nonlocal serial, size
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        words, first = textvec.word_hashes(np.concatenate(raws), offsets)
        lengths = np.diff(first) + 1
        out = np.array(held, bool)
        tokens = np.insert(words, first[1:], END)
        vocab, at = np.unique(tokens, return_inverse=True)
        train = np.repeat(~out, lengths)
        counts = np.bincount(at[train], minlength=len(vocab))
        made = _batch(_TOKENS, [(serial, len(tokens), int(train.sum()), np.array([x or 0 for x in ids], np.int64).tobytes(), np.array([x is None for x in ids], np.uint8).tobytes(), out.astype(np.uint8).tobytes(), lengths.astype(np.int64).tobytes(), _squeezed(at), vocab.tobytes(), counts.astype(np.uint32).tobytes())])
        serial += 1
        for kept in (ids, held, raws, sizes):
            kept.clear()
        size = 0
        return made

    for batch in batches:
        raw, offsets = textvec.utf8(batch.column(1))
        own, out = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        i = 0
        while i < len(own):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES - size, "right")) - 1)
            ids += own[i:j]
            held += out[i:j]
            raws.append(raw[offsets[i] : offsets[j]].copy())
            sizes.append(np.diff(offsets[i : j + 1]))
            size += len(raws[-1])
            if size >= BLOCK_BYTES or j < len(own):
                yield block()
            i = j
    if ids:
        yield block()


def _types(row: dict):
    """Of a block: types in order of word and context, each token's type (-1 for a first token), counts of types and of first tokens."""
    lengths = np.frombuffer(row["lengths"], np.int64)
    tokens = _unsqueezed(row["tokens"], int(lengths.sum())).astype(np.int64)
    n = int(tokens.max()) + 1
    train = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, lengths)
    after = np.ones(len(tokens), bool)
    after[np.cumsum(lengths) - lengths] = False
    at = np.flatnonzero(after)
    keys, inverse = np.unique(tokens[at] * n + tokens[at - 1], return_inverse=True)
    of = np.full(len(tokens), -1, np.int64)
    of[at] = inverse
    counts = np.bincount(of[after & train], minlength=len(keys))
    light = np.bincount(tokens[~after & train], minlength=n)
    return tokens, lengths, keys // n, keys % n, of, counts, light


def _cuts(vocab: np.ndarray, ranges: int) -> np.ndarray:
    where = ((vocab >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(where, np.arange(ranges + 1, dtype=np.uint64))


def _slices(ranges: int):
    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, _, word, ctx, _, counts, light = _types(row)
                vocab = _words(row["vocab"])
                total = np.frombuffer(row["counts"], np.uint32)
                cuts = _cuts(vocab, ranges)
                edges = np.searchsorted(word, cuts)
                out = []
                for r in range(ranges):
                    a, b, c, d = int(cuts[r]), int(cuts[r + 1]), int(edges[r]), int(edges[r + 1])
                    if b > a:
                        own, place = np.unique(ctx[c:d], return_inverse=True)
                        out.append((r, row["block"], vocab[a:b].tobytes(), _packed(total[a:b]), _packed(light[a:b]), vocab[own].tobytes(), _rising(word[c:d] - a), _packed(place), _packed(counts[c:d])))
                yield _batch(_SLICES, out)

    return task


def _by(key: str, batches):
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _words(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _merged(parts: list[tuple]) -> tuple:
    """Parts as one: words with their training counts and first tokens, contexts, and types (places of word and context, count) in order."""
    words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    ctxs, near = np.unique(np.concatenate([p[3] for p in parts]), return_inverse=True)
    total, light = (np.bincount(at, weights=np.concatenate([p[k] for p in parts]), minlength=len(words)).astype(np.int64) for k in (1, 2))
    starts, firsts = (np.cumsum([0] + [len(p[k]) for p in parts]) for k in (0, 3))
    n = max(len(ctxs), 1)
    keys = np.concatenate([at[s + p[4]] * n + near[f + p[5]] for s, f, p in zip(starts, firsts, parts, strict=False)])
    keys, inverse = np.unique(keys, return_inverse=True)
    counts = np.bincount(inverse, weights=np.concatenate([p[6] for p in parts]), minlength=len(keys)).astype(np.int64)
    return words, total, light, ctxs, keys // n, keys % n, counts


def _seat(counts: np.ndarray, pull: np.ndarray, discount: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """A first seating: tables of each type and their sizes. Customers come in growing groups, each of which opens a binomial number of tables."""
    tables = np.ones(len(counts), np.int64)
    done = 1
    while (live := np.flatnonzero(counts > done)).size:
        group = max(1, done // 8)
        m = np.minimum(counts[live] - done, group)
        share = pull[live] / np.maximum(pull[live] + done - discount * tables[live], 1e-9)
        tables[live] += rng.binomial(m, np.clip(share, 0, 1))
        done += group
    ends = np.cumsum(tables)
    sizes = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    rest = counts - tables
    if rest.sum():
        owner = np.repeat(np.arange(len(counts)), rest)
        sizes += np.bincount((ends - tables)[owner] + (rng.random(len(owner)) * tables[owner]).astype(np.int64), minlength=len(sizes))
    return tables, sizes


def _gibbs(counts: np.ndarray, tables: np.ndarray, sizes: np.ndarray, pull: np.ndarray, discount: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """One customer of each type leaves and is seated anew. pull: the weight of a new table."""
    if not len(counts):
        return tables, sizes
    sums = np.cumsum(sizes)
    base = np.cumsum(counts) - counts
    gone = (rng.random(len(counts)) * counts).astype(np.int64)
    left = np.searchsorted(sums, base + gone, "right")
    sizes = sizes.copy()
    sizes[left] -= 1
    empty = sizes[left] == 0
    tables = tables - empty
    stay = counts - 1 - discount * tables
    new = rng.random(len(counts)) * (stay + pull) < pull
    wait = np.flatnonzero(~new)
    while wait.size:
        pick = (rng.random(wait.size) * (counts[wait] - 1)).astype(np.int64)
        pick += pick >= gone[wait]
        at = np.searchsorted(sums, base[wait] + pick, "right")
        ok = rng.random(wait.size) * sizes[at] < sizes[at] - discount
        sizes[at[ok]] += 1
        wait = wait[~ok]
    sizes[left[new & empty]] = 1
    tables = tables + new
    closed = left[empty & ~new]
    ends = np.searchsorted(sums, base + counts, "left") + 1
    opened = ends[new & ~empty]
    keep = np.ones(len(sizes), bool)
    keep[closed] = False
    places = opened - np.cumsum(np.concatenate([[0], ~keep]))[opened]
    return tables, np.insert(sizes[keep], places, 1)


def _places(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... n[0] numbers, and so on."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _reseated(seats: array, sizes: list, pull, discount: float, rng) -> tuple[int, list]:
    """As often as one type has customers, one of them, drawn at random, leaves and is seated anew. seats: each customer's table; pull(tables): the weight of a new table."""
    c, t, free = len(seats), len(sizes), []
    for start in range(0, c, _CHUNK):
        n = min(_CHUNK, c - start)
        leaves, sits = (rng.random(n) * c).astype(np.int64).tolist(), rng.random(n).tolist()
        picks, holds = (rng.random(n) * (c - 1)).astype(np.int64).tolist(), rng.random(n).tolist()
        for k in range(n):
            if k % 8 == 0:
                weight = pull(t)
            gone = leaves[k]
            own = seats[gone]
            sizes[own] -= 1
            if not sizes[own]:
                free.append(own)
                t -= 1
            if sits[k] * (c - 1 - discount * t + weight) < weight:
                to = free.pop() if free else len(sizes)
                if to == len(sizes):
                    sizes.append(0)
                t += 1
            else:
                pick, hold = picks[k], holds[k]
                while True:
                    to = seats[pick + (pick >= gone)]
                    if hold * sizes[to] < sizes[to] - discount:
                        break
                    pick, hold = int(rng.random() * (c - 1)), rng.random()
            seats[gone] = to
            sizes[to] += 1
    return t, [s for s in sizes if s]


def _moved(counts, tables, sizes, word, fresh, base, totals, rng):
    """A sweep: types of about as many customers together, each reseating as many as it has. The root's customers follow every few moves.

    Many types move side by side, customer by customer; the few with many customers move by themselves.
    """
    served = base + _sum(word, len(base), tables)
    tables, starts, parts = tables.copy(), np.cumsum(tables) - tables, []
    order = np.argsort(counts, kind="stable")
    edges = np.searchsorted(counts[order], 1 << np.arange(1, 63, dtype=np.int64))
    for a, b in zip(edges, edges[1:], strict=False):
        own = np.sort(order[a:b])
        if not len(own):
            continue
        t, c = tables[own], counts[own]
        size = sizes[_places(starts[own], t)]
        if len(own) < TOGETHER:
            cuts, made = np.cumsum(t), []
            for x, table in zip(own.tolist(), np.split(size, cuts[:-1]), strict=True):
                w, others = int(word[x]), int(served[word[x]] - tables[x])
                pull = lambda n, w=w, others=others, share=float(fresh[x]): share * totals.word_probability(others + n)
                n, kept = _reseated(array("i", np.repeat(np.arange(len(table), dtype=np.int32), table).tobytes()), table.tolist(), pull, totals.discount, rng)
                served[w] = others + n
                made.append(np.array(kept, np.int64))
            t, size = np.array([len(x) for x in made]), np.concatenate(made)
        else:
            before = t
            for k in range(int(c.max())):
                if k % 8 == 0:
                    served += _sum(word[own], len(base), t - before)
                    before, pull = t, fresh[own] * totals.root_probability(served)[word[own]]
                t, size = _gibbs(c, t, size, pull, totals.discount, rng)
            served += _sum(word[own], len(base), t - before)
        tables[own] = t
        parts.append((own, t, size))
    starts = np.cumsum(tables) - tables
    out = np.zeros(int(tables.sum()), np.int64)
    for own, t, size in parts:
        out[_places(starts[own], t)] = size
    return tables, out


def _totals(served: np.ndarray, fixed) -> bytes:
    """Customers of the root, words served there once and twice; then what is fixed: words, types met once and twice."""
    return np.array([served.sum(), (served == 1).sum(), (served == 2).sum(), *fixed], np.int64).tobytes()


def _sum(places: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(places, weights=weights, minlength=n).astype(np.int64)


def _part(row: dict) -> tuple:
    return _words(row["words"]), _unpacked(row["total"]), _unpacked(row["light"]), _words(row["ctxs"]), _risen(row["type_word"]), _unpacked(row["type_ctx"]), _unpacked(row["type_count"])


def _begun(number: int, parts: list[tuple], slices: list[dict]):
    words, total, light, ctxs, word, ctx, counts = _merged(parts)
    served = light + _sum(word[counts > 0], len(words))
    customers, singles = _sum(ctx, len(ctxs), counts), _sum(ctx[counts == 1], len(ctxs))
    totals = _totals(served, ((total > 0).sum(), (counts == 1).sum(), (counts == 2).sum()))
    n = max(len(ctxs), 1)
    keys, asked = word * n + ctx, []
    for row in slices:
        at, near = np.searchsorted(words, _words(row["words"])), np.searchsorted(ctxs, _words(row["ctxs"]))
        own = at[_risen(row["type_word"])] * n + near[_unpacked(row["type_ctx"])]
        asked.append((_rising(at), _rising(np.searchsorted(keys, own))))
    blocks = np.array([row["block"] for row in slices], np.int64).tobytes()
    return _batch(_TYPES, [(number, words.tobytes(), _packed(total), _packed(light), ctxs.tobytes(), _rising(word), _packed(ctx), _packed(counts), _packed(customers), _packed(singles), totals, blocks, [a for a, _ in asked], [b for _, b in asked])])


def _start(batches):
    """The types of each range; slices are merged as they come, and kept as they came for the places of their types."""
    number, parts, slices, size = None, [], [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if number is not None and row["range"] != number:
                yield _begun(number, parts, slices)
                parts, slices, size = [], [], 0
            number = row["range"]
            slices.append(row)
            parts.append(_part(row))
            size += len(parts[-1][6])
            if size > MERGE_TYPES:
                parts, size = [_merged(parts)], 0
    if parts:
        yield _begun(number, parts, slices)


def _unseated(batches):
    """The types met twice or more, each with one table, and the contexts they have."""
    for batch in batches:
        for row in batch.to_pylist():
            word, ctx, counts = _risen(row["type_word"]), _unpacked(row["type_ctx"]), _unpacked(row["type_count"])
            many = counts > 1
            served = _unpacked(row["light"]) + _sum(word[counts == 1], len(row["words"]) // 8)
            own, place = np.unique(ctx[many], return_inverse=True)
            fixed = np.frombuffer(row["totals"], np.int64)[3:]
            yield _batch(_STATE, [(row["range"], _packed(served), fixed.tobytes(), _words(row["ctxs"])[own].tobytes(), b"", _rising(word[many]), _packed(place), _packed(counts[many]), _packed(np.ones(len(place), np.int64)), b"", [], row["totals"])])


def _sent(owners: int, ask: bool, numbers):
    """Rows to owners: the contexts of a range and for each the numbers that numbers(row, contexts) gives."""

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = _words(row["ctxs"])
                cuts, rows = _cuts(keys, owners), numbers(row, len(keys))
                yield _batch(_SENT, [(o, row["range"], ask, keys[a:b].tobytes(), [_packed(x[a:b]) for x in rows]) for o, a, b in zip(range(owners), cuts, cuts[1:], strict=False) if b > a])

    return task


def _owned(batches):
    """Sums of what was sent for each context, to the ranges that ask."""
    for rows in _by("owner", batches):
        _, at = np.unique(np.concatenate([_words(r["keys"]) for r in rows]), return_inverse=True)
        sums = [_sum(at, 0, np.concatenate([_unpacked(x) for x in column])) for column in zip(*[r["numbers"] for r in rows], strict=True)]
        end = 0
        for r in rows:
            start, end = end, end + len(r["keys"]) // 8
            if r["ask"]:
                yield _batch(_TOLD, [(r["range"], r["owner"], [_packed(x[at[start:end]]) for x in sums])])


def _told(sent: DataFrame) -> DataFrame:
    return sent.repartition("owner").sortWithinPartitions("owner", "range", "ask").mapInArrow(frugal(_owned), _TOLD)


def _joined(rows: list[dict], n: int) -> list[np.ndarray]:
    """Numbers of a range's contexts from its owners' rows, in their order; n: how many there are of each where it has none."""
    return [np.concatenate([_unpacked(x) for x in column]) for column in zip(*[r["numbers"] for r in rows], strict=True)] if rows else [np.zeros(0, np.int64)] * n


class Totals:
    """What all ranges need of all: six numbers."""

    def __init__(self, root: int, root_once: int, root_twice: int, words: int, once: int, twice: int):
        self.root, self.words = float(root), words
        self.discount = float(np.clip(once / (once + 2 * twice) if once else 0.5, 0.05, 0.95))
        self.root_discount = float(np.clip(root_once / (root_once + 2 * root_twice) if root_once else 0.5, 0.05, 0.95))

    def word_probability(self, served: int) -> float:
        """root_probability of one word; root's sum is the sweep's."""
        return (served - self.root_discount if served > 0 else THETA + self.root_discount * self.words) / (THETA + self.root)

    def root_probability(self, served: np.ndarray) -> np.ndarray:
        """Of words by their customers at the root; a word without any has the probability of a new table."""
        return np.where(served > 0, served - self.root_discount, THETA + self.root_discount * self.words) / (THETA + self.root)


def _read_totals(state: DataFrame) -> Totals:
    def task(batches):
        own = np.zeros(6, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                own += np.frombuffer(data, np.int64)
        yield pa.record_batch([pa.array([int(x)]) for x in own], names=list("abcdef"))

    got = state.select("totals").mapInArrow(task, ", ".join(f"{x} long" for x in "abcdef")).agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in "abcdef"]).first()
    return Totals(*got)


def _sweep(totals: Totals, number: int, seed: int):
    def task(batches):
        for rows in _by("range", batches):
            row = rows[0]
            rng = np.random.default_rng([seed, number, row["range"]])
            base, word, u, c = _unpacked(row["served"]), _risen(row["type_word"]), _unpacked(row["type_ctx"]), _unpacked(row["type_count"])
            tables, sizes = _unpacked(row["tables"]), _unpacked(row["sizes"]) if row["sizes"] else None
            singles, many = _joined(rows[1:], 2)
            if row["singles"]:
                singles = _unpacked(row["singles"])
            fresh = (THETA + totals.discount * (singles + many))[u]
            if sizes is None:
                tables, sizes = _seat(c, fresh * totals.root_probability(base + _sum(word, len(base), tables))[word], totals.discount, rng)
            tables, sizes = _moved(c, tables, sizes, word, fresh, base, totals, rng)
            served = base + _sum(word, len(base), tables)
            kept = [*row["samples"], _packed(tables)] if number >= BURN_IN else []
            yield _batch(_STATE, [(row["range"], row["served"], row["fixed"], row["ctxs"], _packed(singles), row["type_word"], row["type_ctx"], row["type_count"], _packed(tables), _packed(sizes), kept, _totals(served, np.frombuffer(row["fixed"], np.int64)))])

    return task


def _swept(state: DataFrame, told: DataFrame, totals: Totals, number: int, seed: int) -> DataFrame:
    both = state.withColumn("owner", F.lit(-1)).unionByName(told, allowMissingColumns=True)
    return written(both.repartition("range").sortWithinPartitions("range", "owner").mapInArrow(frugal(_sweep(totals, number, seed)), _STATE), "state", compression="zstd")


def _predict(samples: list[Totals]):
    """For each slice of a range, in its order: training counts and mean probabilities of its words at the root and of its types."""

    def task(batches):
        for rows in _by("range", batches):
            types, state, told = rows[0], rows[1], rows[2:]
            total, word, ctx, counts = _unpacked(types["total"]), _risen(types["type_word"]), _unpacked(types["type_ctx"]), _unpacked(types["type_count"])
            base, many_word = _unpacked(state["served"]), _risen(state["type_word"])
            customers, singles, *many = _joined(told, 2 + len(samples))
            root, p = np.zeros(len(total)), np.zeros(len(counts))
            for t, s, m in zip(samples, state["samples"], many, strict=True):
                tables = _unpacked(s)
                every = (counts > 0).astype(np.int64)
                every[counts > 1] = tables
                own = t.root_probability(base + _sum(many_word, len(base), tables))
                fresh = (THETA + t.discount * (singles + m)) / (THETA + customers)
                root += own / len(samples)
                p += (fresh[ctx] * own[word] + (counts - t.discount * every) / (THETA + customers[ctx])) / len(samples)
            root, p = root.astype(np.float32), p.astype(np.float32)
            for block, words, asked in zip(np.frombuffer(types["blocks"], np.int64).tolist(), types["asked_words"], types["asked_types"], strict=True):
                at = _risen(words)
                yield _batch(_PREDICTED, [(block, types["range"], _packed(total[at]), root[at].tobytes(), p[_risen(asked)].tobytes())])

    return task


_PREDICTED = "block long, range int, total binary, root binary, types binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def _scored(n_train: int, vocabulary: int):
    def task(batches):
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["range"] < 1 << 30:
                    held.append(row)
                    continue
                tokens, lengths, _, _, of, _, _ = _types(row)
                total = np.concatenate([_unpacked(x["total"]) for x in held])
                root = np.log10(np.concatenate([np.frombuffer(x["root"], np.float32) for x in held]).astype(np.float64))
                types = np.log10(np.concatenate([np.frombuffer(x["types"], np.float32) for x in held]).astype(np.float64))
                held = []
                base = np.log10((total + 1) / (n_train + vocabulary + 1))
                scores = root[tokens]
                scores[of >= 0] = types[of[of >= 0]]
                first = np.cumsum(lengths) - lengths
                sums = [np.add.reduceat(x, first) for x in (total[tokens] > 0, base[tokens], scores)]
                none = np.frombuffer(row["nulls"], np.uint8)
                ids = np.frombuffer(row["docs"], np.int64)
                hold = np.frombuffer(row["held"], np.uint8) == 1
                out += [(None if none[k] else int(ids[k]), bool(hold[k]), int(lengths[k]), int(sums[0][k]), n_train, float(sums[1][k]), float(sums[2][k]), float(10 ** min(300.0, -sums[2][k] / lengths[k]))) for k in range(len(ids))]
            yield _batch(_SCORES, out)

    return task


def scored(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the text and its end) and
    perplexity (of a token: 10 to the power of -score / n_tokens).

    ``held_out`` is a condition on ``doc_id``; where it is true the row isn't learnt from (where null, it is).  Null and empty texts are their
    end alone.  Repeated rows all count.  With no training rows every word is unseen; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = written(rows.mapInArrow(frugal(_blocks), _TOKENS), "blocks", compression="zstd")
    n_train, size = blocks.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    ranges = max(4, -(-size // RANGE_TOKENS))
    owners = max(4, -(-ranges // RANGES_PER_OWNER))
    slices = blocks.drop("docs", "nulls", "n_train", "n_tokens").mapInArrow(frugal(_slices(ranges)), _SLICES)
    types = written(slices.repartition("range").sortWithinPartitions("range", "block").mapInArrow(frugal(_start), _TYPES), "types", compression="zstd")
    del slices
    collect_shuffles(spark)
    state = written(types.mapInArrow(frugal(_unseated), _STATE), "state", compression="zstd")
    totals = _read_totals(state)
    vocabulary, kept = totals.words, []
    for number in range(BURN_IN + SAMPLES):
        sent = state.mapInArrow(frugal(_sent(owners, True, lambda row, n: (np.zeros(n, np.int64), _sum(_unpacked(row["type_ctx"]), n, _unpacked(row["tables"]))))), _SENT)
        if number == 0:
            sent = sent.unionByName(types.mapInArrow(frugal(_sent(owners, False, lambda row, n: (_unpacked(row["singles"]), np.zeros(n, np.int64)))), _SENT))
        before, state = state, _swept(state, _told(sent), totals, number, seed)
        del sent
        discard(before)
        collect_shuffles(spark)
        totals = _read_totals(state)
        if number >= BURN_IN:
            kept.append(totals)
    asked = types.mapInArrow(frugal(_sent(owners, True, lambda row, n: (_unpacked(row["customers"]), _unpacked(row["singles"]), *[np.zeros(n, np.int64)] * SAMPLES))), _SENT)
    given = state.mapInArrow(frugal(_sent(owners, False, lambda row, n: (*[np.zeros(n, np.int64)] * 2, *[_sum(_unpacked(row["type_ctx"]), n, _unpacked(s)) for s in row["samples"]]))), _SENT)
    told = written(_told(asked.unionByName(given)).select("range", (2 + F.col("owner")).alias("step"), "numbers"), "told", compression="zstd")
    del asked, given
    collect_shuffles(spark)
    both = types.select("range", F.lit(0).alias("step"), "total", "type_word", "type_ctx", "type_count", "blocks", "asked_words", "asked_types")
    for x in (state.select("range", F.lit(1).alias("step"), "type_word", "served", "samples"), told):
        both = both.unionByName(x, allowMissingColumns=True)
    fields = ["range", "step", "total", "type_word", "type_ctx", "type_count", "blocks", "asked_words", "asked_types", "served", "samples", "numbers"]
    predicted = written(both.select(fields).repartition("range").sortWithinPartitions("range", "step").mapInArrow(frugal(_predict(kept)), _PREDICTED), "predicted", compression="zstd")
    del both
    for done in (types, state, told):
        discard(done)
    collect_shuffles(spark)
    columns = [*_names(_PREDICTED), "docs", "nulls", "held", "lengths", "tokens"]
    whole = blocks.withColumn("range", F.lit(1 << 30)).unionByName(predicted, allowMissingColumns=True).select(columns)
    whole = whole.repartition("block").sortWithinPartitions("block", "range")
    return whole.mapInArrow(frugal(_scored(int(n_train), int(vocabulary))), _SCORES)
