"""Token ids as binary files with Elias-Fano encoded document boundaries.

A store is a folder of shard files and a manifest table.  Documents lie in
ascending order of doc_id (null ids first); a shard file holds a run of them:

    magic "AUTK", version, id width (2 or 4 bytes), documents, null ids, tokens,
    smallest id, sizes of the two sequences                    (little endian)
    Elias-Fano sequence of document ends (token positions)
    Elias-Fano sequence of doc_id - smallest id (documents without null ids)
    the concatenated token ids

Elias-Fano keeps n non-decreasing numbers up to u in about n * (2 + log2(u / n))
bits: the low bits verbatim, the high bits in unary, plus the position of every
``SKIP``-th one so that ``select`` reads a bounded piece.  No table of 64-bit
offsets is stored.

Writing: documents are range-partitioned by doc_id, tokenized with the tokenizers
library in their partition, and written in files of about ``SHARD_TOKENS`` tokens.
A task writes under a name of its own; only files named in the manifest, whose
rows Spark commits once per successful task, belong to the store, so retries and
lost executors leave at most unused files.  Files go through pyarrow's file systems
to the shared folder.

The library is asked once per distinct piece and slice of a batch, of which Python sees the
distinct pieces only; the tokenizer's normalizer and pre-tokenizer never join text across a
space, so whole texts get the ids that the library gives for them.

Null and empty texts have the end id only.  A very long text is encoded alone and may fill a
shard of its own.  Rows that repeat a doc_id (or have none) lie in the order of a hash of
their texts, spread over as many tasks as it takes; equal rows are stored as often as they
come.  An empty table makes an empty store.  Other columns are not read.
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum.llm.session_tables import written
from aurum.llm.textarrays import slices, text_buffers
from aurum.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 4_000_000
SKIP = 256
#: Remembered chunks: at most so many characters each, and about so many bytes a worker.
KEPT_CHARS, KEPT_BYTES, ENTRY_BYTES = 48, 96 << 20, 220
#: Kinds of Latin-1 characters, as the tokenizer's pre-tokenizer tells them apart in lower-cased text
#: (``'s|'t|'re|'ve|'m|'ll|'d|letters|digit|others``).  ``WHOLE`` is a chunk that is not cut.
SPACE, LETTER, DIGIT, OTHER, WHOLE = range(5)
_KINDS = {LETTER: "[a-zªµºß-öø-ÿ]", DIGIT: "[0-9²³¹¼½¾]", SPACE: "[\\x09-\\x0d\\x20\\x85\\xa0]"}
_LOWER = np.array([ord(chr(c).lower()) for c in range(256)], np.uint8)
_KIND = np.array([next((k for k, s in _KINDS.items() if re.match(s, chr(c))), OTHER) for c in _LOWER.tolist()], np.uint8)
#: The same for bytes of UTF-8 text; those of characters beyond ASCII are looked at in pairs.
_BYTE_LOWER = np.concatenate([_LOWER[:128], np.arange(128, 256, dtype=np.uint8)])
#: New words that go to the library at a time; bytes of texts that are encoded at a time.
ASKED, SLICE = 2000, 4 << 20
_HEAD = struct.Struct("<4sHHQQQqQQ")
_MAGIC = b"AUTK"


# ------------------------------------------------------------ Elias-Fano
def ef_encode(values: np.ndarray) -> bytes:
    """Non-decreasing numbers >= 0 as an Elias-Fano sequence."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low_bits = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
    low = np.zeros((n, low_bits), np.uint8)
    for k in range(low_bits):
        low[:, k] = (v >> np.uint64(k)) & np.uint64(1)
    high = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    unary[high] = 1
    skips = high[::SKIP].astype(np.uint32 if n == 0 or high[-1] < 1 << 32 else np.uint64)
    low, unary = np.packbits(low.ravel(), bitorder="little"), np.packbits(unary, bitorder="little")
    return (struct.pack("<QHHQQ", n, low_bits, skips.itemsize, len(low), len(unary))
            + low.tobytes() + unary.tobytes() + skips.tobytes())


class EliasFano:
    """A read sequence: ``select(i)`` is the i-th number, ``all()`` gives every number."""

    def __init__(self, blob: bytes):
        self.n, self.low_bits, skip_size, low, unary = struct.unpack_from("<QHHQQ", blob)
        at = struct.calcsize("<QHHQQ")
        self.low = np.frombuffer(blob, np.uint8, low, at)
        self.unary = np.frombuffer(blob, np.uint8, unary, at + low)
        self.skips = np.frombuffer(blob, np.uint32 if skip_size == 4 else np.uint64,
                                   -(-self.n // SKIP), at + low + unary)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        bits = np.unpackbits(self.low[first // 8:(first + self.low_bits + 7) // 8], bitorder="little")
        bits = bits[first % 8:first % 8 + self.low_bits].tolist()
        return sum(b << k for k, b in enumerate(bits))

    def select(self, i: int) -> int:
        at = int(self.skips[i // SKIP])
        want, byte = i % SKIP, at // 8
        ahead = 64                                           # grown until the wanted one is in it
        while True:
            bits = np.unpackbits(self.unary[byte:byte + ahead], bitorder="little")
            ones = np.flatnonzero(bits[at - 8 * byte:])
            if len(ones) > want:
                return (int(ones[want]) + at - i << self.low_bits) | self._low(i)
            ahead *= 4

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.unary, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
            for k in range(self.low_bits):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out


# ------------------------------------------------------------ tokenizer
class ChunkEncoder:
    """Ids of whole texts by the tokenizers library, remembered per piece.

    Texts are cut at spaces and newlines.  A chunk of Latin-1 characters is cut into the pieces of
    the tokenizer's own pre-tokenizer; lower-casing and normalising change nothing else about it.
    Any other chunk is one piece.  The pieces of many texts are one Arrow array: they are cut with
    numpy on the bytes, and Python sees the distinct ones only.  New words of Latin-1 letters go to
    the library as one text, whose ids are cut after the tokens that end a word; everything else is
    asked for on its own.  Remembered pieces are short and counted in bytes, in two generations; the
    older one is dropped when the younger is full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.width = np.dtype("<u2" if self.lib.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        vocabulary = self.lib.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _keep(self, made: dict[str, bytes]) -> None:
        short = {c: ids for c, ids in made.items() if len(c) <= KEPT_CHARS}
        self.held += ENTRY_BYTES * len(short) + 2 * sum(map(len, short)) + sum(map(len, short.values()))
        self.young.update(short)
        if self.held >= KEPT_BYTES // 2:
            self.young, self.old, self.held = {}, self.young, 0

    def _ask(self, pieces: list[str]) -> list[bytes]:
        return [array(self.width.char, e.ids).tobytes() for e in self.lib.encode_batch_fast(pieces, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin-1 letters, asked for as one text."""
        ids = np.frombuffer(self._ask([" ".join(words)])[0], self.width)
        cut = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.width.itemsize).tolist()
        if len(cut) != len(words):                           # a word end outside the vocabulary
            return self._ask(words)
        blob = ids.tobytes()
        return [blob[x:y] for x, y in zip([0, *cut], cut)]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        made = list(map(self.young.get, pieces))
        need = [c for c, ids in zip(pieces, made) if ids is None]
        of = {c: self.old[c] for c in need if c in self.old}
        self._keep(of)
        new = [c for c in need if c not in of]
        words, others = [], []
        for c in new:
            (words if c.isalpha() and _latin(c) else others).append(c)
        for ask, encode in ((words, self._words), (others, self._ask)):
            for lo in range(0, len(ask), ASKED):
                some = ask[lo:lo + ASKED]
                got = dict(zip(some, encode(some)))
                of |= got
                self._keep(got)
        return [of[c] if ids is None else ids for c, ids in zip(pieces, made)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        pieces, ends = cut_pieces(texts)
        coded = pieces.dictionary_encode()
        made = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, at, ids = pa.array(made, pa.large_binary()).take(coded.indices).buffers()
        cut = np.frombuffer(at, np.int64)[ends].tolist() if len(pieces) else [0] * len(texts)
        return [ids[x:y].to_pybytes() if x < y else b"" for x, y in zip([0, *cut], cut)]


def cut_pieces(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of every text in one array, and how many there are up to the end of each text."""
    coded = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join([*coded, b"  "]), np.uint8)     # two spaces more, for looking ahead
    kind, low = _KIND[raw], _BYTE_LOWER[raw]
    for lead, first in ((0xC2, 0x80), (0xC3, 0xC0)):         # the other half of Latin-1
        at = np.flatnonzero(raw == lead)
        char = first + (raw[at + 1] & 0x3F)
        kind[at] = kind[at + 1] = _KIND[char]
        low[at + 1] = 0x80 | _LOWER[char] & 0x3F
    odd = raw >= 0xC4                                        # beyond Latin-1, or maybe a special token
    odd[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    odd = np.flatnonzero(odd)
    if len(odd):
        gaps = np.flatnonzero((raw == ord(" ")) | (raw == ord("\n")))
        chunk = np.unique(np.searchsorted(gaps, odd))
        step = np.zeros(len(raw), np.int8)
        step[np.where(chunk > 0, gaps[chunk - 1] + 1, 0)] = 1
        step[gaps[chunk]] = -1
        whole = np.cumsum(step, dtype=np.int8).view(bool)
        kind[whole] = WHOLE
        np.copyto(low, raw, where=whole)
    used = kind != SPACE
    starts = np.ones(len(raw), bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts |= (kind == DIGIT) & (raw & 0xC0 != 0x80)         # every digit is a piece
    starts &= used
    mark = np.flatnonzero(starts & (kind == OTHER) & (raw == ord("'")))
    one, two = low[mark + 1], low[mark + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for some, size in ((mark[short], 2), (mark[long], 3)):   # 's, 't, 'm, 'd; 're, 've, 'll
        starts[some + 1] = False
        starts[some + size] = used[some + size]
    data = low[used]
    at = np.append(np.flatnonzero(starts[used]), len(data))
    pieces = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
    ends = np.cumsum([len(t) + 1 for t in coded], dtype=np.int64)
    return pieces, np.searchsorted(np.flatnonzero(starts), ends)


def _latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


@functools.lru_cache(2)
def load(path: str) -> ChunkEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"           # Spark's tasks are the parallelism
    return ChunkEncoder(path)


# ------------------------------------------------------------ files
class ShardWriter:
    """Collects documents and writes shard files of bounded size."""

    def __init__(self, folder: str, part: int, width: np.dtype, shard_tokens: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.part, self.width, self.limit = part, width, shard_tokens
        self.serial, self.attempt = 0, uuid.uuid4().hex[:12]
        self._clear()

    def _clear(self) -> None:
        self.ids, self.docs, self.ends, self.nulls, self.tokens = [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(ids)
        self.tokens += len(ids) // self.width.itemsize
        self.ends.append(self.tokens)
        if doc_id is None:
            self.nulls += 1
        else:
            self.docs.append(doc_id)

    def flush(self) -> Iterator[tuple]:
        if not self.ends:
            return
        ends = ef_encode(np.array(self.ends, np.uint64))
        low = self.docs[0] if self.docs else 0
        docs = ef_encode(np.array([d - low for d in self.docs], np.uint64))
        path = f"{self.folder}/part-{self.part:06d}-{self.serial:05d}-{self.attempt}.tok"
        with self.fs.open_output_stream(path) as out:
            out.write(_HEAD.pack(_MAGIC, 1, self.width.itemsize, len(self.ends), self.nulls, self.tokens, low,
                                 len(ends), len(docs)))
            out.write(ends)
            out.write(docs)
            for ids in self.ids:
                out.write(ids)
        yield self.part, self.serial, path.rsplit("/", 1)[1], len(self.ends), self.tokens
        self.serial += 1
        self._clear()


class Shard:
    """A read shard file."""

    def __init__(self, blob: bytes):
        magic, version, width, self.n, self.nulls, self.tokens, self.low, ends, docs = _HEAD.unpack_from(blob)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.ends = EliasFano(blob[at:at + ends])
        self.docs = EliasFano(blob[at + ends:at + ends + docs])
        self.ids = np.frombuffer(blob, np.dtype(f"<u{width}"), self.tokens, at + ends + docs)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, found by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.low + int(d) for d in self.docs.all()]


def read_shard(folder: str, name: str) -> Shard:
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/{name}") as f:
        return Shard(f.read())


# ------------------------------------------------------------ Spark
def write_store(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
                shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the store; returns its manifest (part, serial, file, n_docs, n_tokens), written."""
    path = public_tokenizers.path(VOCABULARY) if path is None else path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        end = np.array([end_id], enc.width).tobytes()
        out, rows = ShardWriter(folder, TaskContext.get().partitionId(), enc.width, shard_tokens), []
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for lo, hi in slices(text_buffers(texts)[0], SLICE):
                made = enc.encode_all([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                for d, b in zip(ids[lo:hi], made):
                    out.add(d, b + end)
                    if out.tokens >= shard_tokens:
                        rows += out.flush()
        rows += out.flush()
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=["part", "serial", "file", "n_docs", "n_tokens"])

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"),
                           F.monotonically_increasing_id().alias("row"))
                   .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    return written(ordered.mapInArrow(write, "part bigint, serial bigint, file string, n_docs bigint, n_tokens bigint"),
                   "token-manifest")


def read_store(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    ``start`` adds the tokens of the files before, a running sum over one row per file."""
    before = Window.orderBy("part", "serial").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                shard = read_shard(folder, name)
                ends = shard.ends.all().astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                words = memoryview(shard.ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(words[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch([pa.array(shard.doc_ids(), pa.int64()), pa.array(starts + base),
                                       pa.array(ends - starts), pa.array(crc, pa.int64())],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = files.select("file", "base").repartition(F.col("file"))
    return shards.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def store_round_trip(docs: DataFrame) -> DataFrame:
    """Writes the store into the shared folder and reads it back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-store")
    return read_store(spark, folder, write_store(docs, folder))
