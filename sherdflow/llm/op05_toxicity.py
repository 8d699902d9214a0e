"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digit substitutions); an Aho-Corasick automaton finds the lexicon's whole words
and word beginnings; matches inside exception phrases don't count; the weights' sum, by itself and per hundred words,
goes through a logistic function.

The lexicon is learned from labelled rows: words and beginnings whose odds in toxic texts are far above those in the
others, chosen greedily so that each must explain toxic texts that those before it don't (a word that merely stands
in copies of one toxic text explains nothing new). A few common English insults are there from the start.
The sample is bounded: about max_labelled labelled rows, and max_toxic toxic ones among them, picked by a hash of the
id. Terms are counted, weighed and sifted on the executors, with all words of the sampled texts; the driver gets, of
each toxic text, those of the max_candidates weightiest terms that it has, and picks at most max_terms of them, which
the automaton in each task holds. Every row of the input is scored, over its whole text.

Cases: null or empty text: the score of a text without matches; long texts: whole, one pass; ties and repeated rows:
equal texts have equal scores; a null key is returned and never held out; label rows repeated for one id: toxic if
any is; no labels or labels of one kind only: the first lexicon with fixed coefficients; empty table: empty result;
extra columns: only the named ones are read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import checkpoint, table
from ._text import batches

WORD = re.compile(r"\w+")
#: Lookalikes of Latin letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "κ": "k", "χ": "x", "γ": "y",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ⅼ": "l", "ⅰ": "i", "ⅾ": "d", "ⅽ": "c", "ⅿ": "m", "ß": "ß",
}
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Characters that show nothing.
UNSEEN = "­​‌‍⁠﻿"
FOLD = str.maketrans(LOOKALIKES | SUBSTITUTES | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {chr(0xFF10 + int(d)): s for d, s in SUBSTITUTES.items() if d.isdigit()} | dict.fromkeys(UNSEEN, ""))

FIRST_LEXICON = ("idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting", "trash", "clown", "imbecile", "retard", "bastard", "bitch", "asshole", "fuck*", "shit*", "cunt", "whore", "slut")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "sore loser", "trash collection", "stupid easy")
FIRST_WEIGHT = 4.0


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


def terms(words: set[str]) -> set[str]:
    """Words, and beginnings of words (with a star)."""
    return words | {w[:k] + "*" for w in words for k in range(4, min(8, len(w)))}


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple = EXCEPTIONS
    #: intercept, of log1p(sum of weights), of the sum per hundred words
    coef: tuple = (-3.0, 2.0, 0.2)
    _auto: object = field(default=None, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "coef": self.coef, "_auto": None}

    @property
    def automaton(self):
        if self._auto is None:
            import ahocorasick

            self._auto = ahocorasick.Automaton()
            by_text: dict[str, list] = defaultdict(list)
            for term, w in self.weights.items():
                by_text[term.rstrip("*")].append((w, term.endswith("*")))
            for phrase in self.exceptions:
                by_text[fold(phrase)].append((None, False))
            for text, uses in by_text.items():
                self._auto.add_word(text, (len(text), uses))
            if by_text:
                self._auto.make_automaton()
        return self._auto

    def matches(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Sum of weights and (start, end, weight) of what counts in a folded text."""
        found: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        if len(self.automaton):
            for last, (n, uses) in self.automaton.iter(text):
                start, end = last - n + 1, last + 1
                if start and text[start - 1].isalnum():
                    continue
                whole = end == len(text) or not text[end].isalnum()
                for w, beginning in uses:
                    if whole or beginning:
                        if w is None:
                            spared.append((start, end))
                        elif w > found.get(start, (0, 0.0))[1]:
                            found[start] = (end, w)
        kept = [(s, e, w) for s, (e, w) in found.items() if not any(a <= s and e <= b for a, b in spared)]
        return sum(w for _, _, w in kept), kept

    def features(self, text: str | None) -> tuple[float, float]:
        if not text:
            return 0.0, 0.0
        total, _ = self.matches(fold(text))
        return (math.log1p(total), 100 * total / (text.count(" ") + text.count("\n") + 1)) if total else (0.0, 0.0)

    def score(self, x: float, y: float) -> float:
        z = self.coef[0] + self.coef[1] * x + self.coef[2] * y
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 3000):
            scores = [self.score(*self.features(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["key", "score"])

    def __call__(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """key and score of each row."""
        two = df.select(df[key].cast("long").alias("key"), df[text].cast("string").alias("text"))
        return two.mapInArrow(self.rows, "key long, score double")


@dataclass
class Trainer:
    max_labelled: int = 20_000
    max_toxic: int = 4_000
    max_terms: int = 2_000
    max_candidates: int = 10_000
    support: int = 3
    least_weight: float = 2.5

    def sample(self, df: DataFrame, key: str, text: str, labels: DataFrame) -> DataFrame:
        """text, toxic of the sample; labels: (key, toxic)."""
        labels = labels.groupBy("key").agg(F.max("toxic").alias("toxic")).where("key is not null and toxic in (0, 1)")
        n = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
        toxic = min(n.get(1, 0), self.max_toxic)
        share = {1: toxic / max(1, n.get(1, 0)), 0: (self.max_labelled - toxic) / max(1, n.get(0, 0))}
        roll = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
        ids = labels.where(roll < F.when(F.col("toxic") == 1, F.lit(int(share[1] * (1 << 30)))).otherwise(F.lit(int(min(1.0, share[0]) * (1 << 30)))))
        two = df.select(df[key].cast("long").alias("key"), df[text].cast("string").alias("text"))
        return checkpoint(two.join(F.broadcast(ids), "key").select("text", "toxic"))

    @staticmethod
    def word_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The different words of each text, in order."""
        for b in batches(it, 200):
            words = [sorted(set(WORD.findall(fold(t or "")))) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), b.column(1).cast(pa.int64())], ["words", "toxic"])

    @staticmethod
    def count_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """term, how many toxic and other word sets have it (parts of the sums)."""
        for b in batches(it, 200):
            n: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for words, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for t in terms(set(words)):
                    n[t][toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *(pa.array([v[k] for v in n.values()], pa.int64()) for k in (0, 1))], ["term", "clean", "toxic"])

    def fit(self, df: DataFrame, key: str, text: str, labels: DataFrame) -> Lexicon:
        sample = self.sample(df, key, text, labels)
        first = dict.fromkeys(FIRST_LEXICON, FIRST_WEIGHT)
        # toxic texts of the same words count once, as copies say nothing new
        sets = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(self.word_rows, "words array<string>, toxic long")
        sets = checkpoint(sets.where("toxic = 1").distinct().unionByName(sets.where("toxic = 0")))
        size = {r["toxic"]: r["count"] for r in sets.groupBy("toxic").count().collect()}
        if not size.get(0) or not size.get(1):
            return Lexicon(first)
        n_toxic, n_clean = size[1], size[0]
        counts = sets.mapInArrow(self.count_rows, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
        counts = counts.withColumn("weight", F.round(weight, 9)).where((F.col("toxic") >= self.support) | F.col("term").isin(*FIRST_LEXICON))
        told = (F.col("weight") >= self.least_weight) & (F.col("toxic") >= 4 * F.col("clean")) & (F.col("toxic") >= self.support)
        counts = checkpoint(counts.where(told | F.col("term").isin(*FIRST_LEXICON)).withColumn("told", told))
        known = {r["term"]: (r["toxic"], r["clean"], r["weight"]) for r in counts.where(F.col("term").isin(*FIRST_LEXICON)).collect()}
        best = counts.where("told").orderBy(F.desc(F.col("toxic") * F.col("weight")), "term").limit(self.max_candidates)
        weights = {r["term"]: r["weight"] for r in best.collect()}
        wanted = frozenset(weights) | frozenset(t for t in FIRST_LEXICON)

        def held(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches(it, 200):
                found = [sorted(terms(set(w)) & wanted) for w in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["found"])

        holders: dict[str, list[int]] = defaultdict(list)
        for i, row in enumerate(sorted(r["found"] for r in sets.where("toxic = 1").mapInArrow(held, "found array<string>").collect())):
            for t in row:
                holders[t].append(i)
        return self.chosen(first, known, weights, holders, sample)

    def chosen(self, first: dict, known: dict, weights: dict, holders: dict, sample: DataFrame) -> Lexicon:
        """known: counts in toxic and other texts, and weights, of the first lexicon's words; holders: toxic texts by term."""
        chosen = {}
        for t in first:
            toxic, clean, w = known.get(t, (0, 0, 0.0))
            if toxic >= self.support and w > 0:
                chosen[t] = min(8.0, max(FIRST_WEIGHT, w))
            elif toxic < self.support and not clean:
                chosen[t] = FIRST_WEIGHT
        told = {i for t in chosen for i in holders.get(t, ())}
        heap = [(-len(holders[t]) * w, t, w) for t, w in weights.items() if t not in chosen]
        heapq.heapify(heap)
        while heap and len(chosen) < self.max_terms:
            gain, t, w = heapq.heappop(heap)
            new = sum(i not in told for i in holders[t])
            if new < self.support:
                continue
            if heap and -new * w > heap[0][0]:
                heapq.heappush(heap, (-new * w, t, w))
                continue
            chosen[t] = min(8.0, w)
            told.update(holders[t])
        lexicon = Lexicon(chosen)
        return Lexicon(chosen, coef=self.calibrate(lexicon, sample))

    def calibrate(self, lexicon: Lexicon, sample: DataFrame) -> tuple:
        """Logistic regression (Newton steps, a little ridge) on the sample's two features."""

        def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                x = np.array([lexicon.features(t) for t in b.column(0).to_pylist()]).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), b.column(1).cast(pa.int64())], ["x", "y", "toxic"])

        got = sample.select("text", "toxic").mapInArrow(rows, "x double, y double, toxic long").toPandas().sort_values(["x", "y", "toxic"])
        X = np.column_stack([np.ones(len(got)), got["x"], got["y"]])
        t, b = got["toxic"].to_numpy(float), np.zeros(3)
        ridge = np.diag([1e-3, 1.0, 1.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(X @ b, -30, 30)))
            step = np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + ridge, X.T @ (t - p) - ridge @ b)
            b += step
            if np.abs(step).max() < 1e-9:
                break
        return tuple(float(x) for x in b)


def held_out(key):
    """Rows of no influence on training: crc32(id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Lexicon:
    labels = table(spark, sf_dir, "labels")
    labels = labels.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("key"), F.col("toxic").cast("int").alias("toxic"))
    return Trainer().fit(docs, "doc_id", "text", labels)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; learned from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    out = trained(spark, docs, sf_dir)(docs, "doc_id", "text")
    return out.select(F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
