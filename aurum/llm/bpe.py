"""Byte-level BPE: a backtracking encoder and an offset-table decoder.

Encoding does not replay merges.  A piece's Aho-Corasick matches give, for every
start, the longest vocabulary token that begins there; the shorter ones are its prefixes,
which a table leads through.  The encoder walks left to right and
takes the longest token that is *compatible* with the token before it; when none is,
it steps back and tries the next shorter one.  Two neighbours are compatible when
merging could never have joined bytes across their border.  A prefix of a piece
has exactly one compatible encoding, so a position that failed once is dead and is
not tried again: the walk is linear in the piece.

Compatibility is decided from the merge ranks along the two tokens' edges and kept
in a table.  Grow both sides of the border in order of rank; if, while the left
edge is x and the right edge is y, a merge (x, y) has a lower rank than the next
merge of either edge, it would have happened, and the pair is not compatible.
(At equal ranks the leftmost merge comes first.)

Texts are cut where the pretokenizer always cuts, before each space or line feed,
and the ids of a cut are remembered in a bounded table; texts with runs of three
or more white-space characters, other white space or special tokens take
the pretokenizer's pattern as a whole.  Decoding gathers bytes from one blob
through a table of token offsets.  Workers outlive their tasks, so what a task remembered
goes when it ends.

Null texts count as empty: no ids, empty text.  A very long text is encoded cut by cut.  Rows
are encoded one by one: repeated rows and rows that share a doc_id, or have none, each
give their own result.  An empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.textarrays import bounded_batches, release_memory

VOCABULARY = "byte_bpe_50k.json"
#: Entries of a generation of the tables that a worker keeps (two generations each).
KEPT_CUTS, KEPT_PAIRS = 200_000, 100_000
_NEVER = 1 << 60
#: White space as the pretokenizer's pattern sees it (Unicode White_Space).
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER = re.compile(rf"[{_WS}\x1c-\x1f](?<![ \n])")
_PAIRS, _RUN = ("  ", " \n", "\n ", "\n\n"), re.compile(r"[ \n]{3}|[ \n]{2}\Z")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 stands for itself, the rest follows from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Recent(dict):
    """Made values by key, in two generations: a full one becomes the old one, and what
    is asked for again comes back from there, so frequent keys stay."""

    def __init__(self, make, limit):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit():
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _TakenWhole(Exception):
    """A cut holds white space that may belong with its neighbours'."""


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {s: b for b, s in enumerate(byte_symbols())}
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for s, i in vocab.items():
            self.bytes[i] = bytes(to_byte[c] for c in s) if s not in special else s.encode()
        for s, i in special.items():
            self.bytes[i] = s.encode()
        self.special = special
        self.cut_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        pattern = public_tokenizers.PATTERN.replace(r"[^\s", f"[^{_WS}").replace(r"\S", f"[^{_WS}]").replace(r"\s", f"[{_WS}]")
        self.pieces = regex.compile(pattern).findall
        self.one_word = regex.compile(r" ?\p{L}+").fullmatch

        self.rank: dict[tuple[int, int], int] = {}
        self.made_of: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault((left, right), r)
            self.made_of.setdefault(whole, (left, right, r))
        self.token: dict[str, int] = {}
        self.finder = ahocorasick.Automaton()
        for s, i in vocab.items():
            if s not in special and (i in self.made_of or len(s) == 1):
                text = self.bytes[i].decode("latin-1")
                self.token[text] = i
                if len(text) > 1:
                    self.finder.add_word(text, (len(text) - 1, i))
        self.finder.make_automaton()

        self.matches = self.finder.iter if len(self.finder) else lambda piece: ()
        self.of_byte = {b: self.token[chr(b)] for b in range(256) if chr(b) in self.token}
        #: The next shorter token that begins a token, -1 for none.
        self.shorter = [-1] * size
        for text, i in self.token.items():
            self.shorter[i] = next((self.token[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.token), -1)
        self.length = [len(b) for b in self.bytes]
        sizes = np.array(self.length, np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        self.decimal = np.array([b"%d," % i for i in range(size)])       # padded with zero bytes
        self.size = size
        self.pair = Recent(self._border, lambda: KEPT_PAIRS)     # by one number: tuples would take thrice the memory
        self.cuts = Recent(self._encode_cut, lambda: KEPT_CUTS)
        self.marks = {m: self._encode_part(m) for m in ".,!?"}

    def forget(self) -> None:
        """Empties the tables of what texts brought."""
        for made in (self.pair, self.cuts):
            made.clear()
            made.old = {}

    def _edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that swallows it) along one edge, from the byte up."""
        out, up = [], _NEVER
        while True:
            out.append((t, up))
            if t not in self.made_of:
                return out[::-1]
            up = self.made_of[t][2]
            t = self.made_of[t][side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether a border between tokens a and b survives all merges."""
        return self.pair[a * self.size + b]

    def _border(self, pair: int) -> bool:
        a, b = divmod(pair, self.size)
        return a == self.size or self._survives(self._edge(a, 1), self._edge(b, 0))

    def _survives(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (x, x_up), (y, y_up) = left[i], right[j]
            r = self.rank.get((x, y), _NEVER)
            if r < x_up and r <= y_up and r != _NEVER:
                return False
            if x_up == y_up == _NEVER:
                return True
            if x_up <= y_up:
                i += 1
            else:
                j += 1

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one pretokenizer piece."""
        piece = raw.decode("latin-1")
        whole = self.token.get(piece)
        if whole is not None:
            return [whole]
        longest = list(map(self.of_byte.__getitem__, raw))
        for end, (more, token) in self.matches(piece):
            longest[end - more] = token                      # shorter ones end earlier
        length, shorter, pair, vocabulary, n = self.length, self.shorter, self.pair, self.size, len(raw)
        path = [longest[0]]
        pos, before = length[path[0]], path[0] * vocabulary
        token = longest[pos]
        while True:
            if pair[before + token]:
                path.append(token)
                pos += length[token]
                if pos == n:
                    return path
                before, token = token * vocabulary, longest[pos]
            else:
                token = shorter[token]
            if token < 0:                                    # none is left here: step back
                while token < 0:
                    longest[pos] = -1                        # and do not come again
                    last = path.pop()
                    pos -= length[last]
                    token = shorter[last]
                before = (path[-1] if path else vocabulary) * vocabulary

    def _encode_part(self, text: str) -> bytes:
        ids: list[int] = []
        for p in self.pieces(text):
            ids += self.encode_piece(p.encode("utf-8"))
        return _little(ids)

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        if self.cut_special is not None and "<|" in text:
            parts = self.cut_special.split(text)
            if len(parts) > 1:
                return b"".join(np.uint32(self.special[p]).tobytes() if k % 2 else self.encode_bytes(p)
                                for k, p in enumerate(parts))
        if "\0" in text or any(p in text for p in _PAIRS) and _RUN.search(text):
            return self._encode_part(text)
        # A key is what follows a space; after "\0" it is the text's start, and line feeds begin their own.
        keys = ("\0" + text).replace("\n", " \n").split(" ")
        try:
            return b"".join(map(self.cuts.__getitem__, keys))
        except _TakenWhole:
            return self._encode_part(text)

    def _encode_cut(self, key: str) -> bytes:
        if key[-1:] in self.marks and key[-2:-1].isalpha():      # letters end a piece, the mark is one of its own
            return self.cuts[key[:-1]] + self.marks[key[-1]]
        cut = key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key
        if self.one_word(cut):
            return _little(self.encode_piece(cut.encode("utf-8")))
        if _OTHER.search(cut):
            raise _TakenWhole
        return self._encode_part(cut)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text or ""), np.uint32)

    def decimals(self, ids: np.ndarray) -> bytes:
        """Decimal ids, joined by commas."""
        return self.decimal[ids].tobytes().translate(None, b"\0")[:-1]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        size = self.start[ids + 1] - self.start[ids]
        at = np.cumsum(size)
        take = np.arange(at[-1] if len(at) else 0) + np.repeat(self.start[ids] - at + size, size)
        return self.blob[take].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "replace")


def _little(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@functools.lru_cache(2)
def load(path: str) -> Bpe:
    """One encoder per worker process and vocabulary file."""
    return Bpe(path)


def encoded(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the token ids of a text column."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def ids_of(col: pa.Array) -> pa.Array:
        bpe = load(path)
        lists = [bpe.encode(t.as_py()) for t in col]
        offs = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
        return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.astype(np.int32)))
    return docs.withColumn(name, ids_of(F.col(text)))


def decoded(rows: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with the text of a column of token ids; null ids give a null text."""
    @F.arrow_udf("string")
    def text_of(col: pa.Array) -> pa.Array:
        bpe = load(path)
        return pa.array([None if not x.is_valid else bpe.decode(x.values.to_numpy(zero_copy_only=False)) for x in col],
                        pa.string())
    return rows.withColumn(name, text_of(F.col(ids)))


def digested(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256: encoded, then decoded from the
    ids.  Columns of these names are replaced."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        try:
            for col in cols:
                n, made, back = [], [], []
                for t in col:
                    ids = bpe.encode(t.as_py())
                    n.append(len(ids))
                    made.append(hashlib.sha256(bpe.decimals(ids)).hexdigest())
                    back.append(hashlib.sha256(bpe.decode_bytes(ids.astype(np.int64))).hexdigest())
                yield pa.StructArray.from_arrays(
                    [pa.array(n, pa.int64()), pa.array(made, pa.string()), pa.array(back, pa.string())],
                    ["n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            bpe.forget()
            release_memory()
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in made]).alias("row"), digest(F.col(text)).alias("bpe"))
    return rows.select("row.*", "bpe.*")


def bpe_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    path = public_tokenizers.path(VOCABULARY) if path is None else path
    return digested(docs.select("doc_id", "text"), path).drop("text")
