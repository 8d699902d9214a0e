"""N-gram Jaccard join by grouped prefixes: components of documents that share most of their word shingles.

A document's set is its distinct `shingle`-word shingles (A-Z lower-cased). Shingles have one global order, rarest
first; two sets of Jaccard similarity >= t share a shingle of their prefixes, the first |set| - ceil(t |set|) + 1.

1. Documents with equal sets are collapsed into a class, represented by its smallest doc_id.
2. Classes with identical prefixes and size are collapsed into a group; only a group's leader posts its prefix.
3. Round 1 pairs each posting with its bucket's leader (and each member with its group's leader): as many pairs as
   postings. Verified pairs give components.
4. Round 2 takes the buckets that still hold several components, expands groups to members, and pairs across
   components only: those outside a bucket's largest component with everything of other components in it. Every
   pair that isn't yet joined and passes the filters (size, position, parity bitmap) is verified, so no link between
   different components is lost, and pairs inside a large group of copies are never enumerated.

The order is by estimated frequency: shingles with a large share of all shingles come last, the others by the product
of their words' shares, words without a large share counting as rarest; ties by hash. Both tables of large shares have
at most 2**17 entries by construction. Any order gives the same components; this one keeps buckets small.

Sets are compared as 64-bit hashes of shingles; classes by 128 bits of set hash and the size.

Cases: null or empty text: empty set, linked with nothing; fewer words than a shingle: the whole sequence is the one
shingle; a null doc_id: linked with nothing, component null; rows of one doc_id with different texts: one node, whose
set is that of the row with the greatest text hash; rows that agree: one node, each row returned; empty table: empty
result; extra columns: only the two named ones are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._graph import components
from ._heavy import heavy, local_counts
from ._io import beside, checkpoint, table, tidy
from ._text import Chunk, batches, chunks, give_back, mix

#: pairs of one document that are verified together, and postings of one bucket's smaller components in one part
PART_PAIRS = 256
PART_POSTS = 4_096
_COMMON = np.uint64(255)
#: a set's parity bitmap: bit i tells whether an odd number of its hashes fall on i
BITS = [f"b{i}" for i in range(8)]
N_BITS = 64 * len(BITS)


@dataclass
class JaccardJoin:
    shingle: int = 3
    percent: int = 90

    # --- shingles ---------------------------------------------------------------------------------------------
    def shingles(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a lower-cased chunk: shingle hashes, the document of each, the place of its first word."""
        h, k = c.word_hashes(), self.shingle
        n = np.diff(c.words)
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        doc = np.repeat(np.arange(c.n_docs), count)
        at = c.words[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        out = np.zeros(len(doc), np.uint64)
        last = c.words[doc + 1]
        with np.errstate(over="ignore"):
            for j in range(k):
                there = at + j < last
                out = out * np.uint64(0x9FB21C651E98DF25) + np.where(there, h[np.minimum(at + j, len(h) - 1)], 0) if len(h) else out
        return mix(out), doc, at

    def distinct(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same without repeats inside a document, sorted by document and hash."""
        h, doc, at = self.shingles(c)
        order = np.lexsort((h, doc))
        h, doc, at = h[order], doc[order], at[order]
        keep = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
        return h[keep], doc[keep], at[keep]

    def count_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 5000):
            words, sh = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for c in chunks(b.column(0), lower=True):
                words.append(c.word_hashes())
                sh.append(self.distinct(c)[0])
            words, sh = np.concatenate(words), np.concatenate(sh)
            (hw, nw), (hs, ns) = local_counts(words), local_counts(sh)
            kind = ["word"] * len(hw) + ["shingle"] * len(hs) + ["words", "shingles"]
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.r_[hw, hs, 0, 0]), pa.array(np.r_[nw, ns, len(words), len(sh)])], ["kind", "h", "n"])
        give_back()

    def order(self, rows: DataFrame) -> dict:
        """Tables of the words and shingles with a large share."""
        counts = rows.select("text").mapInArrow(self.count_rows, "kind string, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n")).persist()
        totals = {r["kind"]: r["n"] for r in counts.where("kind in ('words', 'shingles')").collect()}
        words, n = heavy(counts, totals.get("words") or 0, "word")
        common, _ = heavy(counts, totals.get("shingles") or 0, "shingle")
        counts.unpersist()
        share = np.clip(np.log2(np.maximum(n, 1) / max(1, totals.get("words") or 1)) + 18, 1, 18) * 4
        return {"words": words, "share": share.astype(np.uint64), "common": common}

    @staticmethod
    def wide_bitmap(h: np.ndarray) -> np.ndarray:
        """A parity bitmap of a large set, with at least as many bits as it has elements."""
        size = 1 << (len(h) - 1).bit_length()
        return np.packbits((np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).view(np.int64)

    SKETCH = "doc long, tie long, n int, d1 long, d2 long, prefix array<long>, wide array<long>, " + ", ".join(f"{b} long" for b in BITS)

    def prefix_len(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.percent * n // 100) + 1

    def sketch_rows(self, tables: dict):
        words, share, common = tables["words"], tables["share"], tables["common"]

        def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches(it, 3000):
                for c in chunks(b.column(2), lower=True):
                    h, doc, at = self.distinct(c)
                    wh = c.word_hashes()
                    score = np.zeros(len(wh), np.uint64)
                    if len(words) and len(wh):
                        i = np.minimum(np.searchsorted(words, wh), len(words) - 1)
                        score = np.where(words[i] == wh, share[i], 0).astype(np.uint64)
                    rank = np.zeros(len(h), np.uint64)
                    for j in range(self.shingle):
                        rank += np.where(at + j < c.words[doc + 1], score[np.minimum(at + j, len(wh) - 1)], 0) if len(wh) else 0
                    if len(common) and len(h):
                        i = np.minimum(np.searchsorted(common, h), len(common) - 1)
                        rank = np.where(common[i] == h, _COMMON, np.minimum(rank, _COMMON - np.uint64(1)))
                    order = np.lexsort((h, rank, doc))
                    n = np.bincount(doc, minlength=c.n_docs)
                    first = np.cumsum(n) - n
                    size = np.where(n > 0, self.prefix_len(n), 0)
                    pos = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    prefix = h[order][pos].view(np.int64)
                    with np.errstate(over="ignore"):
                        c1 = np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
                        c2 = np.concatenate([[np.uint64(0)], np.cumsum(mix(h * np.uint64(0x9E6C63D0876A9A99)), dtype=np.uint64)])
                        d1, d2 = c1[first + n] - c1[first], c2[first + n] - c2[first]
                    odd = np.bincount(doc * N_BITS + (h & np.uint64(N_BITS - 1)).astype(np.int64), minlength=c.n_docs * N_BITS) & 1
                    bits = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(c.n_docs, len(BITS))
                    wide = [self.wide_bitmap(h[i : i + k]) if k > N_BITS else None for i, k in zip(first.tolist(), n.tolist())]
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(prefix))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(c.first, c.n_docs), b.column(1).slice(c.first, c.n_docs), pa.array(n.astype(np.int32)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), lists, pa.array(wide, pa.list_(pa.int64())), *(pa.array(x) for x in bits.T.copy())],
                        ["doc", "tie", "n", "d1", "d2", "prefix", "wide", *BITS],
                    )
            give_back()

        return rows

    # --- verification -----------------------------------------------------------------------------------------
    def verify_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs (u, v, text of u, text of v), near in u -> the pairs that are linked."""
        last, held = None, None
        for b in batches(it, 500):
            u, v = b.column(0).to_pylist(), b.column(1).to_pylist()
            us, vs = b.column(2), b.column(3)
            sets = []
            for c in chunks(vs, lower=True):
                h, doc, _ = self.distinct(c)
                sets += np.split(h, np.cumsum(np.bincount(doc, minlength=c.n_docs))[:-1])
            keep = []
            for i in range(len(u)):
                if u[i] != last:
                    (c,) = chunks(us.slice(i, 1), lower=True)
                    last, held = u[i], self.distinct(c)[0]
                x, y = held, sets[i]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= self.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(u, keep) if k], pa.int64()), pa.array([x for x, k in zip(v, keep) if k], pa.int64())], ["u", "v"])

    def verified(self, rows: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The linked ones of pairs (u, v). Large sets are compared by their wide bitmaps before texts are fetched.

        A document with very many pairs meets them in parts, each with a copy of what is needed of it.
        """
        pairs = checkpoint(pairs.distinct())
        many = pairs.groupBy("u").agg(F.ceil(F.count("*") / PART_PAIRS).cast("int").alias("parts")).where("parts > 1")
        part = F.pmod(F.xxhash64("v"), F.coalesce("parts", F.lit(1))).cast("int")
        pairs = checkpoint(pairs.join(beside(checkpoint(many)), "u", "left").select("u", part.alias("part"), "v"))
        parts = checkpoint(pairs.select("u", "part").distinct())
        a, b = (classes.select(F.col("rep").alias(x), F.struct("n", "wide").alias(y)) for x, y in (("u", "a"), ("v", "b")))
        full = pairs.join(b, "v").join(parts.join(a, "u"), ["u", "part"])
        # bitmaps of different lengths differ by a factor of two: a half of the longer is laid over the other
        half = lambda x, k: F.slice(x, F.floor(F.size(x) / 2).cast("int") * k + 1, F.floor(F.size(x) / 2).cast("int"))
        folded = lambda x: F.zip_with(half(x, 0), half(x, 1), lambda p, q: p.bitwiseXOR(q))
        x, y = F.col("a.wide"), F.col("b.wide")
        x, y = F.when(F.size(x) > F.size(y), folded(x)).otherwise(x), F.when(F.size(y) > F.size(x), folded(y)).otherwise(y)
        apart = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0).cast("long"), lambda s, k: s + k)
        far = F.col("a.wide").isNotNull() & F.col("b.wide").isNotNull() & ((100 + self.percent) * apart > (100 - self.percent) * (F.col("a.n") + F.col("b.n")))
        pairs = checkpoint(full.where(~far).select("u", "part", "v"))
        del full
        tidy(rows.sparkSession)
        parts = pairs.select("u", "part").distinct()
        ids = pairs.select(F.col("u").alias("doc")).unionByName(pairs.select(F.col("v").alias("doc"))).distinct()
        texts = rows.join(beside(checkpoint(ids)), "doc", "left_semi")
        texts = texts.groupBy("doc").agg(F.max_by("text", "tie").alias("text"))
        a = parts.join(texts.select(F.col("doc").alias("u"), F.col("text").alias("tu")), "u")
        b = texts.select(F.col("doc").alias("v"), F.col("text").alias("tv"))
        full = pairs.join(b, "v").join(a, ["u", "part"]).select("u", "v", "tu", "tv")
        return full.mapInArrow(self.verify_rows, "u long, v long")

    # --- candidates -------------------------------------------------------------------------------------------
    def far_apart(self, a: str, b: str) -> str:
        """Parity bitmaps differ in no more bits than the sets in elements: more than linked sets may differ in."""
        bits = " + ".join(f"bit_count({a}.{x} ^ {b}.{x})" for x in BITS)
        return f"{100 + self.percent}L * ({bits}) > {100 - self.percent}L * ({a}.n + {b}.n)"

    def may_link(self, a: str, b: str):
        """Size, position and bitmap filters on two postings (n, pos, bitmap): no linked pair fails them."""
        p = self.percent
        return F.expr(
            f"100L * {a}.n >= {p}L * {b}.n and 100L * {b}.n >= {p}L * {a}.n "
            f"and {100 + p}L * least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {p}L * ({a}.n + {b}.n) and not {self.far_apart(a, b)}"
        )

    def sketch(self, rows: DataFrame) -> DataFrame:
        return checkpoint(rows.mapInArrow(self.sketch_rows(self.order(rows)), self.SKETCH))

    def classes(self, sketch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Classes of equal sets (rep, n, d1, d2, prefix), and sketch with one set for each doc."""
        real = sketch.where("n > 0 and doc is not null")
        if real.groupBy("doc").agg(F.min("tie").alias("a"), F.max("tie").alias("b")).where("a != b").limit(1).count():
            best = F.max_by(F.struct("n", "d1", "d2", "prefix", "wide", *BITS), "tie").alias("s")
            real = checkpoint(real.groupBy("doc").agg(best).select("doc", "s.*"))
        return real.groupBy("n", "d1", "d2").agg(F.min("doc").alias("rep"), *(F.first(x).alias(x) for x in ("prefix", "wide", *BITS))), real

    def __call__(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """doc, n_shingles, component_id of each row."""
        rows = df.select(df[key].cast("long").alias("doc"), F.xxhash64(df[text]).alias("tie"), df[text].cast("string").alias("text"))
        sketch = self.sketch(rows)
        classes, real = self.classes(sketch)
        classes = checkpoint(classes.withColumn("g1", F.xxhash64("prefix")).withColumn("g2", F.hash("prefix")))
        tidy(df.sparkSession)
        same = ["n", "g1", "g2"]
        groups = classes.groupBy(*same).agg(F.min("rep").alias("leader"), F.count("*").alias("members"), F.first("prefix").alias("prefix"))
        bitmap = classes.select("rep", *BITS)
        several = checkpoint(groups.where("members > 1").select(*same, "leader", F.element_at("prefix", 1).alias("token")))
        member = classes.select("rep", *same).join(several, same, "left").select("rep", F.coalesce("leader", "rep").alias("leader"))
        member = checkpoint(member)
        post = groups.select(F.col("leader"), "n", F.posexplode("prefix").alias("pos", "token"))
        shared = post.groupBy("token").agg(F.min("leader").alias("head"), F.count("*").alias("k")).where("k > 1")
        post = checkpoint(post.join(shared, "token").select("token", "head", "leader", "n", "pos"))
        tidy(df.sparkSession)

        # round 1: everything with its bucket's or group's leader
        heads = post.where("leader = head").select("token", F.col("n").alias("hn"), F.col("pos").alias("hpos"))
        star = post.where("leader != head").join(heads, "token").where(
            f"100L * hn >= {self.percent}L * n and 100L * n >= {self.percent}L * hn and {100 + self.percent}L * least(n - pos, hn - hpos) >= {self.percent}L * (n + hn)"
        )
        star = star.select(F.col("head").alias("u"), F.col("leader").alias("v")).unionByName(member.where("rep != leader").select(F.col("leader").alias("u"), F.col("rep").alias("v"))).distinct()
        a, b = (classes.select(F.col("rep").alias(x), F.struct("n", *BITS).alias(y)) for x, y in (("u", "a"), ("v", "b")))
        star = star.join(a, "u").join(b, "v").where(f"not {self.far_apart('a', 'b')}").select("u", "v")
        tidy(df.sparkSession)
        links = checkpoint(self.verified(rows, star, classes))
        del star, a, b
        tidy(df.sparkSession)
        comp = components(links)

        # round 2: across components, in buckets that still hold several; groups are expanded to their members
        of = member.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "leader", F.coalesce("component", "rep").alias("component"))
        of = checkpoint(of)
        wide = of.groupBy("leader").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        spread = post.join(wide, "leader").groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("token")
        inside = wide.where("lo != hi").select("leader")
        open_ = post.join(spread, "token", "left_semi").select("token", "leader", "n", "pos")
        alone = several.join(inside, "leader", "left_semi").select("token", "leader", "n", F.lit(0).alias("pos"))
        wide_post = open_.unionByName(alone).distinct().join(of, "leader").join(bitmap, "rep").select("token", "rep", "n", "pos", "component", *BITS)
        wide_post = checkpoint(wide_post)
        sizes = wide_post.groupBy("token", "component").agg(F.count("*").alias("k"))
        # the postings outside of a bucket's largest component come in parts, each with all the others beside it
        rest = F.ceil((F.sum("k") - F.max("k")) / PART_POSTS).cast("int")
        major = sizes.groupBy("token").agg(F.max_by("component", F.struct("k", "component")).alias("major"), rest.alias("parts"))
        told = checkpoint(wide_post.join(major, "token"))
        minor = told.where("component != major").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        a, b = minor.alias("a"), told.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("b")
        ahead = F.expr("b.component = a.major or a.rep < b.rep")
        same = (F.col("a.token") == F.col("b.token")) & (F.col("a.part") == F.col("b.part"))
        cross = a.join(b, same & (F.col("a.component") != F.col("b.component")) & ahead & self.may_link("a", "b"))
        cross = cross.select(F.least("a.rep", "b.rep").alias("u"), F.greatest("a.rep", "b.rep").alias("v"))
        tidy(df.sparkSession)
        more = checkpoint(self.verified(rows, cross, classes))
        del cross, a, b, minor, told, major, sizes, wide_post, alone, open_, spread, inside, wide, of, post
        tidy(df.sparkSession)
        if more.limit(1).count():
            comp = components(links.unionByName(more))
        comp = checkpoint(comp)
        del links, more, member, several, groups, shared, heads, bitmap
        tidy(df.sparkSession)

        # back to documents
        reps = classes.select("n", "d1", "d2", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        reps = reps.select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
        of_doc = real.join(reps, ["n", "d1", "d2"]).select("doc", "component").distinct()
        out = sketch.select("doc", F.col("n").cast("long").alias("n_shingles")).join(of_doc, "doc", "left")
        return out.select("doc", "n_shingles", F.coalesce("component", "doc").alias("component_id"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component at 90 % of 3-word shingles."""
    out = JaccardJoin()(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.withColumnRenamed("doc", "doc_id")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
      FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i) AS u),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 90 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) m USING (doc_id)
"""
