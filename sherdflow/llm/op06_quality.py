"""Quality rules with line sequence labelling.

Counts decide first (too few words, too many words in repeated windows). What passes is labelled line by line, as
content or boilerplate, by Viterbi decoding of a linear-chain conditional random field over features of lines; a
document is kept if its words' share in content lines reaches a threshold.

The field is trained on a bounded sample of labelled documents (max_docs) that pass the counts, with all their lines. Labels of documents
are constraints on the hidden labels of lines: in a good document every line is content but those known to repeat;
in a bad one more than half of the words are boilerplate, and which lines bear them is found in turns of fitting (at
first without transitions) and constrained decoding. Lines of three words or more that stand in three sampled
documents or more, each time between other neighbours, are known boilerplate, and being one is a feature. The
threshold is where the sampled documents' shares part good from bad with the least sum of error rates. Every document
is decoded whole.

Repeated windows and known lines are found by 64-bit hashes; repeated lines in a document are compared as text.

Cases: null or empty text: no words, base_failed, not kept; lines without words are labelled but weigh nothing; long
texts are read whole; ties and repeated rows: every row alone; no labels or labels of one kind only: every line is
content; empty table: empty result; extra columns: only the two named ones are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import table
from ._text import SPACE, Chunk, batches, chunks, mix, prefix_hash, span_hash

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CONTINUED = np.zeros(256, bool)
CONTINUED[0x80:0xC0] = True


def _of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER, DIGIT, MARK, STOP = _of(bytes(range(65, 91))), _of(b"0123456789"), _of(b"!?"), _of(b".!?:;")
N_FEATURES = 12


@dataclass
class Counts:
    """Of each document of a chunk: base counts; of its lines: features, words and where each document's begin."""

    base: dict[str, np.ndarray]
    features: np.ndarray
    line_words: np.ndarray
    line_hash: np.ndarray
    lines: np.ndarray


def measure(c: Chunk, known: np.ndarray | None = None, window: int = 8) -> Counts:
    """known: sorted hashes of lines known as boilerplate."""
    n_docs, buf = c.n_docs, c.buf
    total = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    char = total(~CONTINUED[buf] & ~SPACE[buf])
    symbol = total(SYMBOL[buf])

    # words in windows that stand twice or more in their document
    prefix = prefix_hash(buf)
    h, doc = span_hash(prefix, c.starts, c.ends), c.doc_of_word()
    n = len(h)
    cover = np.zeros(n + 1, np.int64)
    if n >= window:
        w = np.zeros(n - window + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(window):
                w = w * np.uint64(0xD1342543DE82EF95) + h[k : n - window + 1 + k]
            w = mix(w) ^ mix(doc[: n - window + 1].astype(np.uint64))
        at = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
        order = at[np.argsort(w[at], kind="stable")]
        same = (w[order[1:]] == w[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        twice = order[np.r_[False, same] | np.r_[same, False]] if len(order) else order
        np.add.at(cover, twice, 1)
        np.add.at(cover, np.minimum(twice + window, n), -1)
    repeated = total(np.cumsum(cover)[:n] > 0)

    # lines
    feed = np.flatnonzero(buf == 10)
    lo = np.sort(np.concatenate([c.off[:-1], feed + 1]))
    doc_of_line = np.sort(np.concatenate([np.arange(n_docs), np.searchsorted(c.off, feed, "right") - 1]))
    hi = np.append(lo[1:], len(buf))
    hi = hi - np.append(doc_of_line[1:] == doc_of_line[:-1], False)
    lines = np.searchsorted(doc_of_line, np.arange(n_docs + 1))
    first, last = np.searchsorted(c.starts, lo), np.searchsorted(c.starts, hi)
    words = last - first
    line_hash = span_hash(prefix, lo, hi)
    told = np.zeros(len(lo), bool)
    if known is not None and len(known):
        told = known[np.minimum(np.searchsorted(known, line_hash), len(known) - 1)] == line_hash
    raw = buf.tobytes()
    again = np.zeros(len(lo), bool)
    seen: set[bytes] = set()
    old = -1
    for i in np.flatnonzero(words > 0).tolist():
        if doc_of_line[i] != old:
            old, seen = doc_of_line[i], set()
        line = raw[lo[i] : hi[i]]
        again[i] = line in seen
        seen.add(line)

    chars = np.maximum(1, char[hi] - char[lo])
    share = lambda mask: (t := total(mask[buf]))[hi] - t[lo]
    echo = total(np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] if n else np.zeros(0, bool))
    wc = np.maximum(1, words)
    end = np.zeros(len(lo), bool)
    full = words > 0
    end[full] = STOP[buf[c.ends[last[full] - 1] - 1]]
    x = np.column_stack([
        np.ones(len(lo)),
        np.log1p(words) / 4,
        np.minimum(1, 4 * (symbol[hi] - symbol[lo]) / chars),
        np.minimum(1, 4 * share(DIGIT) / chars),
        share(UPPER) / chars,
        np.minimum(1, 4 * share(MARK) / chars),
        np.minimum(2, chars / wc / 8),
        (echo[last] - echo[first]) / wc,
        again,
        end,
        words <= 3,
        told,
    ]).astype(float)
    dup = np.bincount(doc_of_line[again], minlength=n_docs)
    base = {"n_words": np.diff(c.words), "word_chars": np.diff(char[c.off]), "n_symbols": np.diff(symbol[c.off]), "n_dup_lines": dup, "n_repeat_words": np.diff(repeated[c.words])}
    return Counts(base, x, words, line_hash, lines)


@dataclass
class LineField:
    """Linear-chain CRF with states 0 content, 1 boilerplate."""

    weights: np.ndarray  # features x 2
    step: np.ndarray  # 2 x 2, from, to
    begin: np.ndarray

    @classmethod
    def fit(cls, docs: list[np.ndarray], states: list[np.ndarray], rounds: int = 120, chain: bool = True, start: LineField | None = None) -> LineField:
        """docs: features of lines; states: of each line. Adam on the penalised log-likelihood; chain: with transitions."""
        n = len(docs)
        order = np.argsort([len(d) for d in docs], kind="stable")
        padded, first = [], 0
        for i in range(1, n + 1):  # padded to at most twice the shortest of a batch
            if i == n or len(docs[order[i]]) > 2 * len(docs[order[first]]):
                padded.append(cls._padded([docs[j] for j in order[first:i]], [states[j] for j in order[first:i]]))
                first = i
        want = sum(cls._wanted(*x) for x in padded)
        theta = np.zeros(N_FEATURES * 2 + 6) if start is None else np.concatenate([start.weights.ravel(), start.step.ravel(), start.begin])
        free = np.ones_like(theta)
        free[N_FEATURES * 2 :] = chain
        m = v = np.zeros_like(theta)
        for r in range(1, rounds + 1):
            f = cls._of(theta)
            have = sum(cls._expected(f, X, mask) for X, mask, _ in padded)
            grad = ((want - have) / n - 1e-3 * theta) * free
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta + 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
        return cls._of(theta)

    @staticmethod
    def _padded(docs: list[np.ndarray], states: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        T, n = max(map(len, docs)), len(docs)
        X, mask, gold = np.zeros((n, T, N_FEATURES)), np.zeros((n, T)), np.zeros((n, T, 2))
        for i, (d, y) in enumerate(zip(docs, states)):
            X[i, : len(d)], mask[i, : len(d)] = d, 1
            gold[i, np.arange(len(d)), y] = 1
        return X, mask, gold

    @staticmethod
    def _wanted(X: np.ndarray, mask: np.ndarray, gold: np.ndarray) -> np.ndarray:
        return np.concatenate([np.einsum("ntf,nts->fs", X, gold).ravel(), np.einsum("ntr,nts->rs", gold[:, :-1], gold[:, 1:]).ravel(), gold[:, 0].sum(0)])

    @staticmethod
    def _expected(f: LineField, X: np.ndarray, mask: np.ndarray) -> np.ndarray:
        n, T = mask.shape
        pairs = mask[:, 1:]
        score = X @ f.weights
        alpha, beta = np.zeros((n, T, 2)), np.zeros((n, T, 2))
        alpha[:, 0] = f.begin + score[:, 0]
        for t in range(1, T):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + f.step, 1) + score[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, nxt, alpha[:, t - 1])
        for t in range(T - 2, -1, -1):
            nxt = np.logaddexp.reduce(f.step + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, nxt, beta[:, t + 1])
        z = np.logaddexp.reduce(alpha[:, -1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
        two = np.exp(alpha[:, :-1, :, None] + f.step + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pairs[:, :, None, None]
        return np.concatenate([np.einsum("ntf,nts->fs", X, p).ravel(), two.sum((0, 1)).ravel(), p[:, 0].sum(0)])

    @classmethod
    def _of(cls, theta: np.ndarray) -> LineField:
        k = N_FEATURES * 2
        return cls(theta[:k].reshape(-1, 2), theta[k : k + 4].reshape(2, 2), theta[k + 4 :])

    def decode(self, x: np.ndarray) -> np.ndarray:
        """States of a document's lines by Viterbi."""
        score = (x @ self.weights).tolist()
        (aa, ab), (ba, bb) = self.step.tolist()
        a, b = self.begin[0] + score[0][0], self.begin[1] + score[0][1]
        back = []
        for s, t in score[1:]:
            from_a, from_b = a + aa >= b + ba, a + ab >= b + bb
            back.append((from_a, from_b))
            a, b = (a + aa if from_a else b + ba) + s, (a + ab if from_b else b + bb) + t
        state = 0 if a >= b else 1
        out = [state]
        for from_a, from_b in reversed(back):
            state = 0 if (from_b if state else from_a) else 1
            out.append(state)
        return np.array(out[::-1])


@dataclass
class Quality:
    field: LineField | None = None
    min_words: int = 20
    max_repeat_percent: int = 30
    min_content: float = 0.5
    max_docs: int = 1500
    turns: int = 2
    known: np.ndarray | None = None  # sorted hashes of lines

    def trained(self, df: DataFrame, key: str, text: str, labels: DataFrame) -> Quality:
        """labels: (key, quality 0 or 1)."""
        labels = labels.groupBy("key").agg(F.min("quality").alias("quality")).where("key is not null and quality in (0, 1)")
        n = {r["quality"]: r["count"] for r in labels.groupBy("quality").count().collect()}
        roll, half = F.pmod(F.xxhash64("key"), F.lit(1 << 30)), self.max_docs // 2
        part = F.when(F.col("quality") == 1, int(min(1, half / max(1, n.get(1, 0))) * (1 << 30))).otherwise(int(min(1, half / max(1, n.get(0, 0))) * (1 << 30)))
        ids = labels.where(roll < part)
        two = df.select(df[key].cast("long").alias("key"), df[text].cast("string").alias("text")).join(F.broadcast(ids), "key")

        def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                for c in chunks(b.column(1)):
                    m = measure(c)
                    part = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(m.lines[:-1], m.lines[1:])], pa.binary())  # noqa: B023, E731
                    cols = [part(m.features.astype(np.float32)), part(m.line_words.astype(np.int32)), part(m.line_hash)]
                    out = pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.n_docs), b.column(2).slice(c.first, c.n_docs).cast(pa.int64()), *cols], ["key", "quality", "x", "words", "lines"])
                    yield out.filter(pa.array(~self.failed(m)))

        got = two.select("key", "text", "quality").mapInArrow(rows, "key long, quality long, x binary, words binary, lines binary").toPandas().sort_values(["key", "x"])
        if got["quality"].nunique() < 2:
            return self
        x = [np.frombuffer(v, np.float32).reshape(-1, N_FEATURES).copy() for v in got["x"]]
        return self.learned(x, [np.frombuffer(v, np.int32) for v in got["words"]], [np.frombuffer(v, np.uint64) for v in got["lines"]], got["quality"].to_numpy(int) == 0)

    def learned(self, x: list[np.ndarray], words: list[np.ndarray], lines: list[np.ndarray], bad: np.ndarray) -> Quality:
        """From features, words and hashes of the lines of each document."""
        between: dict[int, set] = {}
        for h, w in zip(lines, words):
            ends = np.concatenate([[0], h, [1]]).tolist()
            for i in np.flatnonzero(w >= 3).tolist():
                between.setdefault(ends[i + 1], set()).add((ends[i], ends[i + 2]))
        known = np.array(sorted(h for h, x in between.items() if len({a for a, _ in x}) >= 3 and len({b for _, b in x}) >= 3), np.uint64)
        for f, h in zip(x, lines):
            f[:, -1] = np.isin(h, known)
        states = [np.ones(len(f), int) if b else f[:, -1].astype(int) for f, b in zip(x, bad)]
        field = LineField.fit(x, states, chain=False)
        for turn in range(self.turns):
            for i in np.flatnonzero(bad):
                states[i] = self.constrained(field, x[i], words[i])
            field = LineField.fit(x, states, start=field if turn else None)
        share = np.array([self.content(field, f, w) for f, w in zip(x, words)])
        cuts = np.unique(np.r_[share, 0.5])
        cuts = np.append((cuts[1:] + cuts[:-1]) / 2, 0.5)
        loss = [round((share[bad] >= c).mean() + (share[~bad] < c).mean(), 9) for c in cuts]
        cut = min(zip(loss, abs(cuts - 0.5), cuts))[2]
        return Quality(field, self.min_words, self.max_repeat_percent, float(cut), self.max_docs, self.turns, known)

    def failed(self, m: Counts) -> np.ndarray:
        """Documents of a chunk that the counts reject."""
        n = m.base["n_words"]
        return (n < self.min_words) | (100 * m.base["n_repeat_words"] > self.max_repeat_percent * n)

    @staticmethod
    def content(field: LineField, x: np.ndarray, words: np.ndarray) -> float:
        """Share of words in content lines."""
        n = words.sum()
        return float(words[field.decode(x) == 0].sum() / n) if n else 1.0

    @staticmethod
    def constrained(field: LineField, x: np.ndarray, words: np.ndarray) -> np.ndarray:
        """States of a bad document: as decoded, and more boilerplate (what looks most like it) up to half of its words."""
        state = field.decode(x)
        score = x @ field.weights
        for i in np.argsort(score[:, 0] - score[:, 1], kind="stable"):
            if 2 * words[state == 1].sum() > words.sum():
                break
            state[i] = 1
        return state

    SCHEMA = "key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in self.SCHEMA.split(", ")]
        for b in batches(it, 3000):
            for c in chunks(b.column(1)):
                m = measure(c, self.known)
                n = m.base["n_words"]
                failed = self.failed(m)
                share = np.ones(c.n_docs)
                if self.field is not None:
                    for i, (s, e) in enumerate(zip(m.lines[:-1].tolist(), m.lines[1:].tolist())):
                        share[i] = self.content(self.field, m.features[s:e], m.line_words[s:e])
                kept = ~failed & (share >= self.min_content)
                cols = [*(m.base[x] for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), failed, share, kept]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, c.n_docs), *map(pa.array, cols)], names)

    def __call__(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """Counts, share of words in content lines, and verdict of each row."""
        two = df.select(df[key].cast("long").alias("key"), df[text].cast("string").alias("text"))
        return two.mapInArrow(self.rows, self.SCHEMA)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("key"), F.col("quality").cast("int").alias("quality"))
    out = Quality().trained(docs, "doc_id", "text", labels)(docs, "doc_id", "text")
    return out.withColumnRenamed("key", "doc_id")
