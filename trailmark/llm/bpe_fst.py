"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

The merges define which tokens can follow each other: the encoding of every prefix is
unique, and its last token t, after last token s of a shorter prefix, must be a pair that no
merge crosses.  The nondeterministic transducer guesses where tokens end; a state of
the determinised one is the set of token starts that are still open, as their places in the trie of
tokens.  States and transitions are made when first met.  A transition offers the tokens that end with its byte,
and a register holds the last token before each open start, so the one token that may follow is chosen by
pairs.  What the ways to all open starts have in common is emitted: an open start is
never further back than the longest token, so lookahead is bounded.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk_encoder import ChunkCache
from .stage import frugal

#: Kept at most: transitions, and pairs of tokens whose border was looked at. Bytes between emissions.
MAX_STEPS, MAX_PAIRS, FLUSH = 400_000, 400_000, 4096
NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """encode(piece) gives the ids of one match of the splitting pattern."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.trie: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner: list[bool] = [False]
        self.depth: list[int] = [0]
        for token, i in ranks.items():
            node = 0
            for b in token:
                self.inner[node] = True
                nxt = self.trie.get(node << 8 | b)
                if nxt is None:
                    nxt = self.trie[node << 8 | b] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.token_at[node] = i
        self.spines: dict[int, tuple[list[int], list[int]] | None] = {}
        self.follows: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple[int, ...], int] = {}
        self.open: list[tuple[int, ...]] = []
        self.table: dict[int, tuple[int, list[tuple[int, int]]]] = {}
        self.start = self._state((0,))

    def _state(self, nodes: tuple[int, ...]) -> int:
        got = self.states.get(nodes)
        if got is None:
            got = self.states[nodes] = len(self.open)
            self.open.append(nodes)
        return got

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or a token that merges never reach."""
        parts = [bytes([b]) for b in self.tokens[token]]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], NEVER))
            if self.ranks.get(parts[best] + parts[best + 1], NEVER) >= token:
                return None
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) < 2 or any(p not in self.ranks for p in parts):
            return None
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _spine(self, token: int) -> tuple[list[int], list[int]] | None:
        """The symbols at the token's left and right edge while it is built, from byte to token; None if merges never make it."""
        if token not in self.spines:
            if len(self.tokens[token]) == 1:
                self.spines[token] = ([token], [token])
            else:
                halves = self._halves(token)
                a, b = (self._spine(halves[0]), self._spine(halves[1])) if halves else (None, None)
                self.spines[token] = (a[0] + [token], b[1] + [token]) if a and b else None
        return self.spines[token]

    def _pair(self, s: int, t: int) -> bool:
        """Whether token t can follow token s: no merge across their border comes before those that build them."""
        if len(self.follows) > MAX_PAIRS:
            self.follows.clear()
        left, right = self._spine(s), self._spine(t)
        ok = left is not None and right is not None
        if ok:
            a, b = left[1], right[0]
            i = j = 0
            while True:
                up_a = a[i + 1] if i + 1 < len(a) else NEVER
                up_b = b[j + 1] if j + 1 < len(b) else NEVER
                across = self.ranks.get(self.tokens[a[i]] + self.tokens[b[j]], NEVER)
                if across < up_a and across <= up_b and across != NEVER:
                    ok = False
                    break
                if up_a == NEVER and up_b == NEVER:
                    break
                if up_a <= up_b:
                    i += 1
                else:
                    j += 1
        self.follows[s << 32 | t] = ok
        return ok

    def _step(self, state: int, byte: int) -> tuple[int, list[tuple[int, int]]]:
        """The transition for a byte, made and kept: the next state, and (token, length) of the tokens that end, the longest first."""
        reached = [n for n in (self.trie.get(node << 8 | byte) for node in self.open[state]) if n is not None]
        ending = [(t, len(self.tokens[t])) for t in (self.token_at[n] for n in reached) if t >= 0]
        got = self._state((*[n for n in reached if self.inner[n]], 0)), ending
        self.table[state << 8 | byte] = got
        return got

    def _way(self, last: list[int], first: int, end: int) -> list[int]:
        """The tokens from position first to end."""
        out, tokens = [], self.tokens
        while end > first:
            token = last[end]
            out.append(token)
            end -= len(tokens[token])
        out.reverse()
        return out

    def _agreed(self, last: list[int], starts: list[int], first: int) -> int:
        """The last position that the ways to all open starts pass."""
        places = sorted(set(starts))
        while len(places) > 1:
            at = places.pop()
            at = max(first, at - len(self.tokens[last[at]]))
            if at not in places:
                places.append(at)
                places.sort()
        return places[0]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.table) > MAX_STEPS:
            self._reset()
        table, follows, state, out = self.table, self.follows, self.start, []
        last = [-1]  # of each position since the last emission: the token that ends there
        begin = first = 0  # position in the piece of last[0], which ends a token that is emitted already
        for at, byte in enumerate(piece, 1):
            got = table.get(state << 8 | byte)
            if got is None:
                got = self._step(state, byte)
            state, ending = got
            place = at - begin
            for token, length in ending:
                before = last[place - length] if length <= place else None
                if before is None:
                    continue
                if before < 0:
                    ok = self._spine(token) is not None
                else:
                    ok = follows.get(before << 32 | token)
                    if ok is None:
                        ok = self._pair(before, token)
                if ok:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if place >= FLUSH:
                cut = self._agreed(last, [place - self.depth[n] for n in self.open[state]], first)
                out += self._way(last, first, cut)
                # The last position kept before the cut gives the token before it.
                last, begin = last[cut:], begin + cut
        return out + self._way(last, first, len(last) - 1)


class FstEncoder(ChunkCache):
    """Whole texts by the transducer, each match of the pattern separately; chunks are kept as ids."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        import regex

        self.fst = Transducer(read_ranks(path))
        if max(self.fst.tokens) > 65535:
            raise ValueError("ids beyond 16 bits")
        self.matches = regex.compile(pattern).findall

    def whole(self, text: str) -> bytes:
        encode = self.fst.encode
        out: list[int] = []
        for piece in self.matches(text):
            out += encode(piece.encode())
        return array("H", out).tobytes()

    def chunk(self, chunk: str) -> bytes:
        return self.whole(" " + chunk)


class Utf8Machine:
    """Incremental UTF-8: feed(bytes) gives the text of the complete characters so far, end() what is left.

    A state is the number of continuation bytes still wanted and the range of the next one.  Runs of bytes that
    are well-formed as a whole are passed at once; others byte by byte, and each longest part of a character that can't be
    completed becomes one U+FFFD.
    """

    #: Wanted continuation bytes and the range of the first, by lead byte.
    LEADS = {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)} | {b: (2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF) for b in range(0xE0, 0xF0)} | {b: (3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF) for b in range(0xF0, 0xF5)}

    def __init__(self):
        self.begun = b""  # of a character
        self.state = (0, 0x80, 0xBF)

    def _byte(self, byte: int) -> str:
        wanted, low, high = self.state
        if wanted:
            if low <= byte <= high:
                self.begun += bytes([byte])
                self.state = (wanted - 1, 0x80, 0xBF)
                if wanted > 1:
                    return ""
                out, self.begun = self.begun.decode(), b""
                return out
            self.begun, self.state = b"", (0, 0x80, 0xBF)
            return "\ufffd" + self._byte(byte)
        if byte < 0x80:
            return chr(byte)
        if byte not in self.LEADS:
            return "\ufffd"
        self.begun, self.state = bytes([byte]), self.LEADS[byte]
        return ""

    def feed(self, data: bytes) -> str:
        out, at = [], 0
        while self.state[0] and at < len(data):
            out.append(self._byte(data[at]))
            at += 1
        end = len(data)
        while end > at and end > len(data) - 4 and data[end - 1] & 0xC0 == 0x80:
            end -= 1
        end = max(at, end - 1) if end > at and data[end - 1] >= 0xC0 else len(data)  # the last character may be unfinished
        try:
            out.append(data[at:end].decode("utf-8"))
        except UnicodeDecodeError as e:
            out.append(data[at : at + e.start].decode("utf-8"))
            end = at + e.start
        return "".join(out) + "".join(map(self._byte, data[end:]))

    def end(self) -> str:
        out = "\ufffd" if self.begun else ""
        self.begun, self.state = b"", (0, 0x80, 0xBF)
        return out


class Decoder:
    """Ids to text, in blocks; every id's bytes are gathered from one table."""

    def __init__(self, ranks: dict[bytes, int], block: int = 1 << 16):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.block = block

    def raw(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        return self.data[np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)].tobytes()

    def text(self, ids: np.ndarray):
        """The text, a part at a time."""
        machine = Utf8Machine()
        for a in range(0, len(ids), self.block):
            yield machine.feed(self.raw(ids[a : a + self.block]))
        yield machine.end()


_kept: dict = {}


@contextmanager
def _encoder(path: str, pattern: str):
    """The worker's encoder and decoder during a task; kept chunks are dropped afterwards, the transducer stays."""
    if (path, pattern) not in _kept:
        enc = FstEncoder(path, pattern)
        _kept[path, pattern] = enc, Decoder(enc.fst.ranks)
    enc, dec = _kept[path, pattern]
    try:
        yield enc, dec
    finally:
        enc.forget()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row, in the table's order.

    ``ranks_path`` is a file of token ranks on every worker.  Null and empty texts have no ids; rows are
    independent, so repeated rows and identifiers and null identifiers are kept; other columns are ignored.
    """

    def task(batches):
        with _encoder(ranks_path, pattern) as (enc, _):
            for batch in batches:
                ids = [x.astype(np.int32) for x in enc.encode(t.as_py() for t in batch.column(1))]
                yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(frugal(task), "doc_id long, ids array<int>")


def decoded(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; bytes that aren't UTF-8 become U+FFFD, null ids are empty."""

    def task(batches):
        with _encoder(ranks_path, pattern) as (_, dec):
            for batch in batches:
                texts = ["".join(dec.text(np.array(x.as_py() or [], np.int64))) for x in batch.column(1)]
                yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(frugal(task), "doc_id long, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: each text encoded, its ids decoded again, both digested. Cases as encoded()."""

    def task(batches):
        with _encoder(ranks_path, pattern) as (enc, dec):
            for batch in batches:
                counts, ids_sha, text_sha = [], [], []
                for ids in enc.encode(t.as_py() for t in batch.column(1)):
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(_decimal(ids)).hexdigest())
                    sha = hashlib.sha256()
                    for part in dec.text(ids):
                        sha.update(part.encode("utf-8"))
                    text_sha.append(sha.hexdigest())
                yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, id_col, text_col).mapInArrow(frugal(task), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _decimal(ids: np.ndarray) -> bytes:
    """The ids in decimal, joined by single spaces."""
    listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids).cast(pa.string()))
    return pc.binary_join(listed, " ")[0].as_buffer().to_pybytes() if len(ids) else b""
