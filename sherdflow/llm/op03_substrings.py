"""Substring dedup by super-k-mer partitioning.

A window is `window` consecutive words of one document. Each window's minimiser is the least of its `mmer`-word
hashes; consecutive windows with the same minimiser travel as one packed string to the minimiser's bucket, so equal
windows meet, and each word travels about three times rather than `window` times. In a bucket the windows are sorted
and every occurrence but the first is removed.

* M-mers with a large share of all words rank behind all others, so a passage that is everywhere doesn't draw the
  windows at its edges into one bucket. They are at most 2**17 by construction, whatever the input.
* Equal packed strings of one batch are settled before the shuffle: all but the first are repeats, and only the first
  travels. So a group of copies sends one string for each batch, not for each copy.
* Hashes choose buckets and bring candidates together; equality is decided on the words' bytes.

"First" is the smallest (doc, start), null doc last; among different texts with one doc id the one with the smaller
text hash. Rows that agree in doc and text are one document, each row gets its result.

Cases: null or empty text: no words, kept text empty; fewer words than a window: nothing is removed; long texts are
scanned whole; empty table: empty result; extra columns: only the two named ones are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._heavy import heavy, local_counts
from ._io import partitions, table
from ._text import Chunk, batches, chunks, give_back, mix, prefix_hash, scan, sliding_min, span_hash

_TOP = np.uint64(1 << 63)
#: packed text of a bucket, about
BUCKET_BYTES = 12 << 20


@dataclass
class SubstringDedup:
    window: int = 20
    mmer: int = 3

    # --- minimisers -------------------------------------------------------------------------------------------
    def mmers(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the m-mer at each word (garbage where it leaves the document), and whether it stays inside."""
        h = c.word_hashes()
        n, m = len(h), self.mmer
        out = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(m):
                out[: n - m + 1] = out[: n - m + 1] * np.uint64(0xD1342543DE82EF95) + h[k : n - m + 1 + k]
        ends = np.repeat(c.words[1:], np.diff(c.words))
        return mix(out), np.arange(n) + m <= ends

    def count_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 5000):
            got, n = [], 0
            for c in chunks(b.column(0)):
                h, inside = self.mmers(c)
                got.append(h[inside])
                n += len(h)
            h, k = local_counts(np.concatenate(got)) if got else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            kind = ["mmer"] * len(h) + ["words"]
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.append(h, 0)), pa.array(np.append(k, n))], ["kind", "h", "n"])

    # --- packing ----------------------------------------------------------------------------------------------
    #: A row is what one batch has for one bucket: a compressed block of super-k-mers, or of settled repeats.
    PACKED = "bucket long, settled boolean, size long, block binary"

    def pack_rows(self, hot: np.ndarray, n_buckets: int):
        W, M = self.window, self.mmer

        def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches(it, 2000):
                docs, ties = b.column(0).to_pylist(), b.column(1).to_pylist()
                keys = [(d is None, d or 0, t) for d, t in zip(docs, ties)]
                first: dict[bytes, tuple] = {}
                again: list[tuple] = []
                for c in chunks(b.column(2)):
                    n = len(c.starts)
                    if n < W:
                        continue
                    h, inside = self.mmers(c)
                    rank = h >> np.uint64(1)
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                        rank = np.where(hot[at] == h, rank | _TOP, rank)
                    least = sliding_min(rank, W - M + 1)[: n - W + 1]
                    doc_of = c.doc_of_word()
                    at = np.flatnonzero(doc_of[: n - W + 1] == doc_of[W - 1 :])  # windows, by their first word
                    if not len(at):
                        continue
                    low, owner = least[at], doc_of[at]
                    cut = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])])
                    a, z = at[cut], np.append(at[cut[1:] - 1], at[-1]) + W  # words [a, z)
                    text, starts, ends = c.joined()
                    raw = text.tobytes()
                    local = a - c.words[owner[cut]]
                    for s, e, low_, d, i, k in zip(starts[a].tolist(), ends[z - 1].tolist(), low[cut].tolist(), (owner[cut] + c.first).tolist(), local.tolist(), (z - a).tolist()):
                        packed = raw[s:e]
                        mine = (d, i, k, low_)
                        had = first.setdefault(packed, mine)
                        if had is not mine and (had[1] != i or keys[had[0]] != keys[d]):
                            if (keys[d], i) < (keys[had[0]], had[1]):
                                first[packed], mine = mine, had
                            again.append(mine)
                out = [(b.num_rows * 31 + len(again), True, 0, self._block(docs, ties, np.array(again, np.uint64), b""))] if again else []
                if first:
                    packed, meta = list(first), np.array(list(first.values()), np.uint64)
                    first = {}
                    bucket = (mix(meta[:, 3]) % np.uint64(n_buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    edge = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1], True])
                    for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
                        own = order[x:y]
                        body = b"\n".join([packed[i] for i in own.tolist()])
                        out.append((int(bucket[own[0]]), False, len(body), self._block(docs, ties, meta[own], body)))
                packed = again = None
                cols = list(zip(*out)) or [[]] * 4
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], ["bucket", "settled", "size", "block"])
            give_back()

        return rows

    @staticmethod
    def _block(docs: list, ties: list, meta: np.ndarray, body: bytes) -> bytes:
        """meta: (row of the batch, start, words, minimiser) of each string; body: the strings, a line each."""
        used, doc = np.unique(meta[:, 0].astype(np.int64), return_inverse=True)
        value = np.array([docs[i] or 0 for i in used.tolist()], np.int64)
        null = np.array([docs[i] is None for i in used.tolist()], np.uint8)
        tie = np.array([ties[i] for i in used.tolist()], np.int64)
        head = np.array([len(used), len(meta)], np.int64)
        sub = (meta[:, 3] >> np.uint64(8)).astype(np.uint16)
        parts = [head, value, null, tie, doc.astype(np.int32), meta[:, 1].astype(np.int32), meta[:, 2].astype(np.int32), sub]
        raw = b"".join([x.tobytes() for x in parts]) + body
        return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 6).compress(raw, asbytes=True)

    @staticmethod
    def _unblock(block: bytes) -> dict:
        raw = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
        k, n = np.frombuffer(raw, np.int64, 2).tolist()
        at, out = 16, {}
        for name, kind, m in (("value", np.int64, k), ("null", np.uint8, k), ("tie", np.int64, k), ("doc", np.int32, n), ("start", np.int32, n), ("words", np.int32, n), ("sub", np.uint16, n)):
            out[name] = np.frombuffer(raw, kind, m, at)
            at += m * np.dtype(kind).itemsize
        doc = out.pop("doc")
        out |= {x: out[x][doc] for x in ("value", "null", "tie")}
        return out | {"body": raw[at:]}

    # --- buckets ----------------------------------------------------------------------------------------------
    SPANS = "doc long, tie long, start long, stop long"

    def bucket_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input is sorted by bucket; each bucket is worked off in parts of a few MB, by bits of the minimiser."""
        bucket, held, size = None, [], 0
        for b in batches(it, 64):
            for key, settled, n, block in zip(*(b.column(i).to_pylist() for i in range(4))):
                if settled:
                    x = self._unblock(block)
                    yield self._told(x["value"], x["null"], x["tie"], x["start"].astype(np.int64), x["start"].astype(np.int64) + x["words"])
                    continue
                if key != bucket and held:
                    yield from self._parts(held, size)
                    held, size = [], 0
                bucket = key
                held.append(block)
                size += n
        if held:
            yield from self._parts(held, size)
            held = []
        give_back()

    @staticmethod
    def _told(value, null, tie, start, stop) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(value, mask=null.astype(bool)), pa.array(tie), pa.array(start), pa.array(stop)], ["doc", "tie", "start", "stop"])

    def _parts(self, held: list[bytes], size: int) -> Iterator[pa.RecordBatch]:
        n_parts = max(1, -(-size // (1 << 20)))
        parts: list[list] = [[] for _ in range(n_parts)]
        for block in held:
            x = self._unblock(block)
            body = np.frombuffer(x.pop("body"), np.uint8)
            edge = np.append(np.flatnonzero(body == 10), len(body))
            lo = np.append(0, edge[:-1] + 1)
            part = x["sub"] % n_parts
            for p in np.unique(part).tolist():
                own = np.flatnonzero(part == p)
                if n_parts > 1:
                    lens = edge[own] - lo[own]
                    pos = np.repeat(lo[own] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
                    piece = body[pos]
                else:
                    piece, lens = body[body != 10], edge - lo
                parts[p].append((piece, lens, *(x[k][own] for k in ("value", "null", "tie", "start"))))
        for i, p in enumerate(parts):
            parts[i] = None
            if p:
                cols = [np.concatenate(c) for c in zip(*p)]
                yield from self._spans(cols[0], np.concatenate([[0], np.cumsum(cols[1])]), *cols[2:])

    def _spans(self, buf: np.ndarray, off: np.ndarray, doc: np.ndarray, null: np.ndarray, tie: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Words of repeated windows among these packed strings (start: the place of each in its document)."""
        W, start = self.window, start.astype(np.int64)
        c = scan(0, buf, off)
        rec = c.doc_of_word()
        at = np.flatnonzero(np.arange(len(rec)) + W <= c.words[rec + 1])
        lo, hi = c.starts[at], c.ends[at + W - 1]
        h = span_hash(prefix_hash(buf), lo, hi)
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        if not same.any():
            return
        twin = order[np.r_[False, same] | np.r_[same, False]]
        by = np.lexsort((tie, doc, null))
        rank = np.empty(len(by), np.int64)  # equal for equal documents
        rank[by] = np.cumsum(np.r_[0, (tie[by[1:]] != tie[by[:-1]]) | (doc[by[1:]] != doc[by[:-1]]) | (null[by[1:]] != null[by[:-1]])])
        place = start[rec[at[twin]]] + at[twin] - c.words[rec[at[twin]]]
        owner = rank[rec[at[twin]]]
        twin_order = np.lexsort((place, owner, h[twin]))
        twin, place, owner = twin[twin_order], place[twin_order], owner[twin_order]
        raw = buf.tobytes()
        repeat = np.zeros(len(twin), bool)
        hs, los, his = h[twin].tolist(), lo[twin].tolist(), hi[twin].tolist()
        owners, places = owner.tolist(), place.tolist()
        value = None
        firsts: dict[bytes, tuple] = {}
        for i, x in enumerate(hs):
            if x != value:
                value, firsts = x, {}
            w = raw[los[i] : his[i]]
            had = firsts.get(w)
            if had is None:
                firsts[w] = (owners[i], places[i])
            elif had != (owners[i], places[i]):
                repeat[i] = True
        hit = at[twin[repeat]]
        if not len(hit):
            return
        step = np.bincount(hit, minlength=len(rec) + W + 1).astype(np.int64)
        step[W:] -= step[:-W].copy()
        covered = np.cumsum(step)[: len(rec)] > 0
        edge = covered.astype(np.int8)
        begins = np.flatnonzero(covered & np.r_[True, (edge[1:] > edge[:-1]) | (rec[1:] != rec[:-1])])
        stops = np.flatnonzero(covered & np.r_[(edge[1:] < edge[:-1]) | (rec[1:] != rec[:-1]), True]) + 1
        r = rec[begins]
        shift = start[r] - c.words[r]
        yield self._told(doc[r], null[r], tie[r], begins + shift, stops + shift)

    # --- results ----------------------------------------------------------------------------------------------
    KEPT = "doc long, n_words long, n_removed long, kept string"

    def kept_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 3000):
            spans = b.column(2).to_pylist()
            for c in chunks(b.column(1)):
                drop = np.zeros(len(c.starts) + 1, np.int64)
                for i in range(c.n_docs):
                    for s in spans[c.first + i] or ():
                        drop[c.words[i] + s["start"]] += 1
                        drop[c.words[i] + s["stop"]] -= 1
                gone = np.cumsum(drop)[:-1] > 0
                text, starts, ends = c.joined()
                text = text[np.repeat(~gone, ends - starts + 1)]
                left = np.concatenate([[0], np.cumsum(np.where(gone, 0, ends - starts + 1))])[c.words]
                raw = text.tobytes()
                kept = [raw[s : max(s, e - 1)].decode() for s, e in zip(left[:-1].tolist(), left[1:].tolist())]
                removed = np.concatenate([[0], np.cumsum(gone)])[c.words]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.n_docs), pa.array(np.diff(c.words)), pa.array(np.diff(removed)), pa.array(kept)], ["doc", "n_words", "n_removed", "kept"])
        give_back()

    def __call__(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """doc, n_words, n_removed and the kept words joined by a space, of each row."""
        spark = df.sparkSession
        rows = df.select(df[key].cast("long").alias("doc"), F.xxhash64(df[text]).alias("tie"), df[text].cast("string").alias("text"))
        counts = rows.select("text").mapInArrow(self.count_rows, "kind string, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n")).where(f"n >= 2 or kind = 'words'").persist()
        total = counts.where("kind = 'words'").agg(F.sum("n")).first()[0] or 0
        hot, _ = heavy(counts, total, "mmer")
        counts.unpersist()
        n = max(partitions(spark), total * 20 >> 28)
        n_buckets = max(n, total * 20 // BUCKET_BYTES)
        spans = (
            rows.mapInArrow(self.pack_rows(hot, n_buckets), self.PACKED)
            .repartition(n, "bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(self.bucket_rows, self.SPANS)
            .groupBy("doc", "tie")
            .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
        )
        a, b = rows.alias("a"), spans.alias("b")
        joined = a.join(b, F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.tie") == F.col("b.tie")), "left")
        return joined.select("a.doc", "a.text", "b.spans").mapInArrow(self.kept_rows, self.KEPT)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated 20-word windows."""
    out = SubstringDedup()(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS win FROM d, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i) AS u),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM x),
g AS (SELECT DISTINCT doc_id, j FROM r, LATERAL (SELECT unnest(range(i, i + 20)) AS j) AS u WHERE nth > 1),
l AS (SELECT doc_id, list(j) AS gone FROM g GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
             list_filter(list_zip(w, range(1, len(w) + 1)), lambda p: gone IS NULL OR NOT list_contains(gone, p[2])) AS kept
      FROM d LEFT JOIN l USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(kept, lambda p: p[1]), ' ')) AS kept_sha256
FROM k
"""
