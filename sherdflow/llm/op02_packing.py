"""Packing along a space-filling curve.

A document's words are hashed into a vector, projected to a few dimensions, and the point's place on a Hilbert curve
is its key. Documents are range-sorted by (key, document), so neighbours on the curve are neighbours in the
sequences; each range then fills sequences of at most `length` token ids, cutting documents where a sequence is full.
What is left at a range's end is cut at powers of two, which need no padding.

Text is what is shuffled; each text is tokenised once, after the shuffle. Equal documents have equal keys, so the
range sort takes the document's hash as a second column: a group of copies of any size is spread over ranges.

Cases: null or empty text: one id 0; long texts: cut over many sequences, never shortened; ties and repeated rows:
every row is packed for itself, rows that agree in everything are interchangeable; empty table: empty result; extra
columns: only the two named ones are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import bytes_of, partitions, table
from ._text import batches, chunks

END = 0  # the id after each document
#: a range holds about so much of the input, as Spark estimates its size, or less
RANGE_BYTES = 64 << 20


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points (n, dims) of unsigned `bits`-bit coordinates (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            hit = (x[i] & q) != 0
            t = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@dataclass
class Curve:
    """Hashed word counts -> signed projection to `dims` -> `bits` a coordinate -> Hilbert key."""

    features: int = 256
    dims: int = 4
    bits: int = 12

    def keys(self, column: pa.Array) -> np.ndarray:
        signs = np.random.default_rng(2).standard_normal((self.features, self.dims))
        out = []
        for c in chunks(column):
            h = c.word_hashes()
            at = c.doc_of_word() * self.features + (h % np.uint64(self.features)).astype(np.int64)
            sign = np.where(h >> np.uint64(63), 1.0, -1.0)
            v = np.bincount(at, sign, c.n_docs * self.features).reshape(c.n_docs, self.features)
            norm = np.sqrt((v * v).sum(1, keepdims=True))
            y = (v / np.maximum(norm, 1e-12)) @ signs
            cells = np.clip((y + 3) / 6 * (1 << self.bits), 0, (1 << self.bits) - 1)  # +-3 standard deviations
            out.append(hilbert(cells.astype(np.int64), self.bits))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array(self.keys(b.column(1))), b.column(0), b.column(1)], ["curve_key", "doc", "text"])


class BytePairs:
    """Ids of whole texts, equal to those of `tokenizers` with the vocabulary file `path`.

    A pre-token never reaches over the place before a single space that stands between other characters, so texts
    are cut there and the ids of each piece are remembered. Texts with runs of blanks take the library's own way
    through `ranks`, the same vocabulary; texts that hold a special token's string go to `tokenizers` itself.
    """

    MEMORY = 300_000
    RUN = re.compile(r" \s* ")

    def __init__(self, path: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        encode = self.fast.encode_ordinary

        class Memory(dict):
            """The last pieces met, in two generations: what the older one still serves moves up."""

            older: dict[str, bytes] = {}

            def __missing__(self, piece: str) -> bytes:
                ids = self.older.get(piece)
                if ids is None:
                    ids = array("I", encode(" " + piece)).tobytes()
                if len(self) >= BytePairs.MEMORY:
                    self.older = dict(self)
                    self.clear()
                self[piece] = ids
                return ids

        self.memory = Memory()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.RUN.search(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        head, *rest = text.split(" ")
        return array("I", self.fast.encode_ordinary(head)).tobytes() + b"".join(map(self.memory.__getitem__, rest))


_made: dict[tuple, BytePairs] = {}


def public_tokenizer(name: str = "byte_bpe_50k") -> BytePairs:
    import public_tokenizers as P

    if name not in _made:
        _made[name] = BytePairs(P.path(f"{name}.json"), P.path(f"{name}.tiktoken"), P.PATTERN)
    return _made[name]


@dataclass
class Pack:
    """Packs documents in curve order; tokenizer: makes the function text -> ids on the executor."""

    tokenizer: Callable[[], Callable[[str], bytes]] = public_tokenizer
    length: int = 1024
    curve: Curve = None
    keep_ids: bool = True

    def schema(self) -> str:
        return "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * self.keep_ids

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, L = self.tokenizer(), self.length
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        seq = fill = 0
        held: list[tuple] = []  # pieces of the sequence that is not yet full

        def out(rows: list[tuple]) -> pa.RecordBatch:
            names = [x.split()[0] for x in self.schema().split(", ")]
            kinds = [pa.int64()] * 7 + [pa.binary()] * self.keep_ids
            cols = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        def row(doc, start, ids, total, s, offset) -> tuple:
            return (doc, start, len(ids) // 4, zlib.crc32(ids), total, part + s, offset, *([ids] if self.keep_ids else []))

        for b in batches(it, 1000):
            done = []
            for doc, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids = encode(text or "") + END.to_bytes(4, "little")
                total, at = len(ids) // 4, 0
                while at < total:
                    n = min(L - fill, total - at)
                    held.append((doc, at, ids[4 * at : 4 * (at + n)], total, seq, fill))
                    at, fill = at + n, fill + n
                    if fill == L:
                        done += [row(*x) for x in held]
                        held, fill, seq = [], 0, seq + 1
            yield out(done)
        tail = []
        size = 1 << (fill.bit_length() - 1) if fill else 0  # the largest power of two goes first
        room, offset = size, 0
        left = fill
        for doc, start, ids, total, _, _ in held:
            at, n = 0, len(ids) // 4
            while at < n:
                k = min(room, n - at)
                tail.append(row(doc, start + at, ids[4 * at : 4 * (at + k)], total, seq, offset))
                at, room, offset, left = at + k, room - k, offset + k, left - k
                if not room:
                    seq, offset = seq + 1, 0
                    room = 1 << (left.bit_length() - 1) if left else 0
        yield out(tail)

    def __call__(self, df: DataFrame, key: str, text: str) -> DataFrame:
        two = df.select(df[key].cast("long").alias("doc"), df[text].cast("string").alias("text"))
        keyed = two.mapInArrow((self.curve or Curve()).rows, "curve_key long, doc long, text string")
        n = max(partitions(df.sparkSession), bytes_of(two) // RANGE_BYTES)
        order = ["curve_key", "spread", "doc"]
        ranged = keyed.withColumn("spread", F.xxhash64("doc")).repartitionByRange(n, *order).sortWithinPartitions(*order)
        return ranged.select("curve_key", "doc", "text").mapInArrow(self.rows, self.schema())


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    out = Pack(keep_ids=False)(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.withColumnRenamed("doc", "doc_id")
