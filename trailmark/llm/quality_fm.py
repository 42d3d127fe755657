"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).  The pairwise part is
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), linear in the features at hand.

Features of a whole text: its distinct words in WORDS hashed buckets (weight one over the root of the buckets met; only
buckets that LEAST learnt rows share have a weight), one bin for each of the statistics in STATISTICS, and one bin for each metadata column,
here the character count that the table gives.
Weights are learnt on the driver from SAMPLE labelled rows at most, those with the smallest
hashes of their identifiers; a row has MAX_WORDS of its buckets there at most, those with the smallest hashes,
so the sample has at most SAMPLE * MAX_WORDS * 4 bytes (48 MB; a fifth of that as measured).  Scores use all words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec
from .stage import frugal

WORDS, BINS, FACTORS, SAMPLE, MAX_WORDS, LEAST = 1 << 16, 24, 8, 6000, 2000, 3
SLICE = 1 << 21
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"!", b"|", b"#$%&*@^~=+<>\\/_{}[]", b".,;:?", b"'\"()-", bytes(range(128, 256)))
STATISTICS = ("upper", "lower", "digits", "spaces", "lines", "exclamations", "bars", "symbols", "stops", "quotes", "non_ascii", "repeats", "distinct", "word_bytes", "words", "top_word", "line_repeats")
METADATA = ("n_chars",)
SIZE = WORDS + BINS * (len(STATISTICS) + len(METADATA))
_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _c in enumerate(_CLASSES):
    _OF[list(_c)] = _k


@dataclass
class Words:
    """Buckets of the words of rows: those of row i are at[first[i] : first[i + 1]], each once, all with weight[i]."""

    at: np.ndarray
    first: np.ndarray

    @property
    def weight(self) -> np.ndarray:
        return 1 / np.sqrt(np.maximum(np.diff(self.first), 1))

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """For each row the sum of the entries, which are one for each of its buckets."""
        out = np.zeros((len(self.first) - 1, *entries.shape[1:]), np.float64)
        full = np.flatnonzero(np.diff(self.first))
        if len(full):
            out[full] = np.add.reduceat(entries, self.first[:-1][full], axis=0)
        return out

    def rows(self, chosen: np.ndarray) -> Words:
        sizes = np.diff(self.first)[chosen]
        first = np.concatenate([[0], np.cumsum(sizes)])
        return Words(self.at[np.repeat(self.first[chosen] - first[:-1], sizes) + np.arange(first[-1])], first)


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def parts(self, words: Words, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and the sums of factors times features. bins: (n, statistics and metadata) feature numbers of weight 1."""
        v, w, x = self.factors, self.weights, words.weight
        own = v[words.at]
        linear = x * words.sums(w[words.at]) + w[bins].sum(axis=1)
        sums = x[:, None] * words.sums(own) + v[bins].sum(axis=1)
        squares = x[:, None] ** 2 * words.sums(own * own) + (v[bins] ** 2).sum(axis=1)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def logits(self, words: Words, bins: np.ndarray) -> np.ndarray:
        return self.parts(words, bins)[0]


def _log_bin(x: np.ndarray) -> np.ndarray:
    """Bins of a share, two for each doubling from 1/4096 up."""
    return np.clip(np.floor(2 * np.log2(1 + 4096 * x)), 0, BINS - 1).astype(np.int64)


def _slice_features(raw: np.ndarray, offsets: np.ndarray, metadata: np.ndarray) -> tuple[Words, np.ndarray]:
    n = len(offsets) - 1
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    classes = _OF[raw]
    counts = np.zeros((len(_CLASSES), n))
    for k in range(len(_CLASSES)):
        if len(full):
            counts[k, full] = np.add.reduceat(classes == k, offsets[:-1][full], dtype=np.int64)
    shares = counts / np.maximum(size, 1)
    words, first = textvec.word_hashes(raw, offsets)
    tokens = np.diff(first)
    owner = np.repeat(np.arange(n), tokens)
    same = np.zeros(len(words), bool)
    if len(words):
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner, weights=same, minlength=n)
    keys = textvec.mix(words + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    fresh = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else np.zeros(0, np.int64)
    distinct = np.bincount(owner[order[fresh]], minlength=n) if len(keys) else np.zeros(n)
    most = np.zeros(n, np.int64)
    if len(keys):
        np.maximum.at(most, owner[order[fresh]], np.diff(np.append(fresh, len(keys))))
    bucket = np.unique(owner * WORDS + ((words >> np.uint64(40)).astype(np.int64) & (WORDS - 1)))
    table = Words((bucket % WORDS).astype(np.int32), np.searchsorted(bucket, np.arange(n + 1) * WORDS))
    per = np.maximum(tokens, 1)
    letters = size - counts[3] - counts[4]
    linear = lambda x: np.clip(np.floor(x * (BINS - 1)), 0, BINS - 1).astype(np.int64)
    bins = [_log_bin(s) for s in shares]
    bins += [_log_bin(repeats / per), linear(distinct / per), np.clip(np.floor(2 * letters / per), 0, BINS - 1).astype(np.int64), np.clip(np.floor(1.5 * np.log2(1 + tokens)), 0, BINS - 1).astype(np.int64), _log_bin(most / per), _log_bin(_line_repeats(raw, offsets))]
    bins += [np.clip(np.floor(1.2 * np.log2(1 + np.maximum(m, 0))), 0, BINS - 1).astype(np.int64) for m in metadata]
    return table, np.stack(bins, axis=1) + WORDS + BINS * np.arange(len(bins))


def _line_repeats(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of each text's bytes in lines that came earlier in it."""
    out = np.zeros(len(offsets) - 1)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        lines = raw[a:b].tobytes().split(b"\n")
        if len(lines) > 1 and len(set(lines)) < len(lines):
            seen: set[bytes] = set()
            again = 0
            for line in lines:
                if line in seen:
                    again += len(line)
                seen.add(line)
            out[i] = again / (b - a)
    return out


def features(column: pa.Array, *metadata: pa.Array):
    """(words, bins) of consecutive slices of a string column; a slice has about SLICE bytes or is one text. Null metadata count as 0."""
    raw, offsets = textvec.utf8(column)
    given = np.stack([pc.fill_null(m.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False) for m in metadata]) if metadata else np.zeros((len(METADATA), len(column)))
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, min(i + 2000, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1))
        yield _slice_features(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], given[:, i:j])
        i = j


def learn(words: Words, bins: np.ndarray, labels: np.ndarray, rows_seen: int = 60_000, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> Model:
    """Logistic loss by Adagrad on mini-batches, about ``rows_seen`` rows in 10 to 80 epochs; the same rows give the same model.  Without rows of both labels the score is constant."""
    rng = np.random.default_rng(seed)
    rate_of_ones = (labels.sum() + 1.0) / (len(labels) + 2.0)
    model = Model(float(np.log(rate_of_ones / (1 - rate_of_ones))), np.zeros(SIZE, np.float32), np.zeros((SIZE, FACTORS), np.float32))
    if len(set(labels.tolist())) < 2:
        return model
    known = np.bincount(words.at, minlength=WORDS) >= LEAST
    model.factors[WORDS:] = rng.normal(0, 0.05, (SIZE - WORDS, FACTORS))
    model.factors[:WORDS][known] = rng.normal(0, 0.05, (int(known.sum()), FACTORS))
    gw, gv, gb = np.full(SIZE, 1e-3, np.float32), np.full((SIZE, FACTORS), 1e-3, np.float32), 1e-3
    for _ in range(int(np.clip(rows_seen // len(labels), 10, 80))):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), 128):
            chosen = order[a : a + 128]
            x, b, y = words.rows(chosen), bins[chosen], labels[chosen]
            logit, sums = model.parts(x, b)
            error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - y) / len(y)
            # Entries of the batch: feature, row, value; buckets that too few rows share stay at 0.
            owner = np.concatenate([np.repeat(np.arange(len(y)), np.diff(x.first)), np.repeat(np.arange(len(y)), b.shape[1])])
            at, value = np.concatenate([x.at, b.ravel()]), np.concatenate([np.repeat(x.weight, np.diff(x.first)), np.ones(b.size)])
            keep = np.concatenate([known[x.at], np.ones(b.size, bool)])
            touched, place = np.unique(at[keep], return_inverse=True)
            owner, value = owner[keep], value[keep]
            pull = error[owner] * value
            dw = np.bincount(place, pull) + decay * model.weights[touched]
            dv = np.stack([np.bincount(place, pull * sums[owner, f]) for f in range(FACTORS)], axis=1) + (decay - np.bincount(place, pull * value))[:, None] * model.factors[touched]
            db = float(error.sum())
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            gb += db * db
            model.weights[touched] -= rate * dw / np.sqrt(gw[touched])
            model.factors[touched] -= 0.5 * rate * dv / np.sqrt(gv[touched])
            model.bias -= rate * db / np.sqrt(gb)
    return model


def _metadata(docs: DataFrame) -> list:
    """The metadata columns as doubles; null where the table lacks them or they aren't numbers."""
    kinds = dict(docs.dtypes)
    return [(F.col(m).cast("double") if re.match(r"(tiny|small|big)?int|double|float|decimal", kinds.get(m, "")) else F.lit(None).cast("double")).alias(f"__{m}") for m in METADATA]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out_mod: int = 5, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows whose crc32(identifier as text) mod ``held_out_mod`` isn't 0.

    Rows with a null identifier, a null label or no document are not learnt from; of rows that share an identifier the first
    by text counts, so repeated rows don't add to the sample; no rows give a constant score.
    """
    few = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % held_out_mod != 0))
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *_metadata(docs)).join(F.broadcast(few), "doc_id").select("doc_id", "label", "text", *[f"__{m}" for m in METADATA])

    def task(batches):
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            out = []
            for words, bins in features(*batch.columns[2:]):
                for k in range(len(bins)):
                    own = words.at[words.first[k] : words.first[k + 1]]
                    if len(own) > MAX_WORDS:
                        own = own[np.argpartition(textvec.mix(own.astype(np.uint64)), MAX_WORDS)[:MAX_WORDS]]
                    out.append((ids[at], labels[at], own.astype(np.int32).tobytes(), bins[k].astype(np.int32).tobytes()))
                    at += 1
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "label", "words", "bins"])

    made = rows.mapInArrow(frugal(task), "doc_id long, label int, words binary, bins binary")
    table = made.groupBy("doc_id").agg(F.min(F.struct("words", "bins", "label")).alias("r")).select("doc_id", "r.*").toArrow().sort_by("doc_id")
    own = [np.frombuffer(x, np.int32) for x in table["words"].to_pylist()]
    words = Words(np.concatenate(own) if own else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64))
    bins = np.frombuffer(b"".join(table["bins"].to_pylist()), np.int32).reshape(-1, len(STATISTICS) + len(METADATA)).astype(np.int64)
    return learn(words, bins, table["label"].to_numpy().astype(np.float64))


def _scores(model: Model, *columns: pa.Array) -> np.ndarray:
    got = [model.logits(w, b) for w, b in features(*columns)]
    return 1 / (1 + np.exp(-np.clip(np.concatenate(got), -30, 30))) if got else np.zeros(0)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row; null and empty texts are scored by their (empty) features. Repeated rows and null identifiers are kept."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(_scores(given.value, *batch.columns[1:]), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *_metadata(docs)).mapInArrow(frugal(task), "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose score is at least ``least``; null and empty texts are scored like others, repeated rows each, and an empty table gives no rows."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    names, schema = docs.columns, docs.schema
    made = docs.select(*docs.columns, F.col(text_col).cast("string").alias("__text"), *_metadata(docs))

    def task(batches):
        for batch in batches:
            scores = _scores(given.value, *batch.columns[len(names) :])
            yield pa.record_batch(batch.columns[: len(names)], names=names).filter(pa.array(scores >= least))

    return made.mapInArrow(frugal(task), schema)
