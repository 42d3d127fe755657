"""Tokenizer files applied by chunks: texts are cut at spaces and each distinct chunk is encoded once.

A chunk is a space and what follows it up to the next space.  No token of either
vocabulary crosses the start of a chunk, but for white-space runs; texts that have
such runs go to the library whole.  Ids are little-endian uint16: both vocabularies
are smaller than 65,536.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np

#: Distinct chunks kept during a task and characters of the longest that is kept (about 60 MB together), characters
#: encoded together, and characters of a piece of a very long text.
MAX_CHUNKS, KEPT_CHARS, BATCH_CHARS, PIECE_CHARS = 250_000, 48, 1 << 20, 1 << 22
_RUN = re.compile(r"\s (?:\s|\Z)")
#: A stop or comma between a letter and a space is a chunk of its own, shown by a NUL; texts with a NUL go to the library whole.
_MARK = re.compile(r"[.,](?= )(?<=[A-Za-z].)")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Letters, numbers and white space of Latin-1.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
#: A byte's character in byte-level vocabularies: itself if it prints, else the next one from U+0100.
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
_encoders: dict = {}


def pieces(text: str) -> Iterator[str]:
    """A very long text cut before spaces between two words; others whole."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        m = _SAFE.search(text, at + PIECE_CHARS)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


class Kept(dict):
    """Values made when first asked for; those of long keys are made each time."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        got = self.make(key)
        if len(key) <= KEPT_CHARS:
            self[key] = got
        return got


class ChunkCache:
    """encode(texts) for subclasses that can encode whole texts and single chunks."""

    known = True  # whether chunks can be encoded apart

    def __init__(self):
        self.cache = Kept(self._made)
        self.heads = Kept(self.whole)  # first chunks of texts, which have no space before them
        self.marks: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop what is kept."""
        self.cache.clear()
        self.heads.clear()

    def whole(self, text: str) -> bytes:
        raise NotImplementedError

    def chunk(self, chunk: str) -> bytes:
        """The ids of a chunk, given without its space."""
        raise NotImplementedError

    def split(self, text: str) -> list[str]:
        """The chunks of a text, without their spaces; the first has none before it."""
        return _MARK.sub(r" \0\g<0>", text).split(" ")

    def _made(self, chunk: str) -> bytes:
        """A word with a stop or comma is the word's ids and the mark's, unless lower case adds a mark to the word."""
        if chunk[-1:] in self.marks and chunk[:-1].isalpha() and chunk.lower()[:-1].isalpha():
            return self.cache[chunk[:-1]] + self.marks[chunk[-1]]
        return self.chunk(chunk)

    def _some(self, texts: list[str]) -> list[bytes]:
        for kept, most in ((self.cache, MAX_CHUNKS), (self.heads, MAX_CHUNKS // 8)):
            if len(kept) > most:
                kept.clear()
        if not self.marks:
            self.marks = {c: self.whole(c) for c in ".,"}
        self.cache.update(("\0" + c, ids) for c, ids in self.marks.items())
        get, out = self.cache.__getitem__, []
        for text in texts:
            if not self.known or "\0" in text or _RUN.search(text):
                out.append(self.whole(text))
            else:
                head, *rest = self.split(text)
                out.append(self.heads[head] + b"".join(map(get, rest)))
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """uint16 ids of each text; null is empty."""
        held: list[str] = []
        parts: list[int] = []

        def out():
            got = iter(self._some(held))
            for n in parts:
                yield np.frombuffer(b"".join(next(got) for _ in range(n)), "<u2")

        size = 0
        for text in texts:
            own = list(pieces(text or "")) if self.known else [text or ""]
            held += own
            parts.append(len(own))
            size += len(text or "")
            if size > BATCH_CHARS:
                yield from out()
                held, parts, size = [], [], 0
        if parts:
            yield from out()


#: Options of a BPE model that change what it gives.
_MODEL = ("type", "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
_PLAIN = dict.fromkeys(_MODEL) | {"type": "BPE"}


class LibraryEncoder(ChunkCache):
    """By the tokenizers library; strings of special tokens in a text are ordinary text.

    Chunks of Latin-1 are cut into matches of the file's splitting pattern here, and the library's
    model encodes each match: its normalizers and pre-tokenizers cost several times what the model does.
    """

    #: The file's splitting pattern, with the classes that it has in Latin-1.
    pattern = ""
    #: What a file must say for that; texts of other files go to the library whole.
    expects: dict = {}

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path} has ids beyond 16 bits")
        with open(path, encoding="utf-8") as f:
            says = json.load(f)
        model = {k: v for k, v in says["model"].items() if k not in ("vocab", "merges")}
        self.known = {"normalizer": says["normalizer"], "pre_tokenizer": says["pre_tokenizer"], "post_processor": says["post_processor"], "model": {k: model.get(k) or None for k in _MODEL}} == self.expects
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokens = self.tokenizer.model.tokenize
        self.two = [i.to_bytes(2, "little") for i in range(65536)]
        self.matches = re.compile(self.pattern).findall
        self.parts = Kept(self.piece)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2").tobytes()

    def piece(self, match: str) -> bytes:
        """The ids of one match, by the library's model."""
        if match.isascii() and match.isprintable():
            match = match.replace(" ", _BYTE_CHARS[32])
        else:
            match = match.encode().decode("latin-1").translate(_BYTE_CHARS)
        two = self.two
        return b"".join([two[t.id] for t in self.tokens(match)])

    def forget(self) -> None:
        super().forget()
        self.parts.clear()

    def _pieces(self, text: str) -> bytes:
        if len(self.parts) > MAX_CHUNKS // 8:
            self.parts.clear()
        return b"".join(map(self.parts.__getitem__, self.matches(text)))


class ByteLevelEncoder(LibraryEncoder):
    """Byte-level vocabulary: the chunk's space is part of its first token."""

    expects = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "post_processor": None, "model": _PLAIN}

    def _made(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            two = self.two
            return b"".join([two[t.id] for t in self.tokens("Ġ" + chunk)])
        return super()._made(chunk)

    pattern = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

    def chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and max(chunk) < "\u0500":  # letters in every version of Unicode
            return self.piece(" " + chunk)
        return self._pieces(" " + chunk) if max(chunk, default="") < "\u0100" else self.whole(" " + chunk)


class WordEndEncoder(LibraryEncoder):
    """Vocabulary with word ends, which drops white space and case: line ends and tabs count as spaces."""

    _SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    expects = {
        "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
        "post_processor": None,
        "model": _PLAIN | {"end_of_word_suffix": "</w>"},
    }

    def _made(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            two = self.two
            return b"".join([two[t.id] for t in self.tokens(chunk.lower())])
        return super()._made(chunk)

    pattern = f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"

    def split(self, text: str) -> list[str]:
        text = text.replace("\n", " ").replace("\t", " ")
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        return ["", *super().split(text)]

    def chunk(self, chunk: str) -> bytes:
        if max(chunk, default="") >= "\u0100":
            return self.whole(chunk)
        return self.piece(chunk.lower()) if chunk.isalpha() else self._pieces(chunk.lower())


@contextmanager
def encoder(kind: type, path: str):
    """The worker's own encoder for a file, during a task: its chunks are dropped afterwards, its vocabulary stays."""
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    got = _encoders[kind, path]
    try:
        yield got
    finally:
        got.forget()
