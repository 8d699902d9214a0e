"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

A candidate is what fixed patterns leave of a run of token characters, if it has 20 characters or more. Its
characters are scored by two second-order Markov models (smoothed towards first and zeroth order); it is a secret of
kind `markov` if the mean log-likelihood ratio reaches the threshold.

Labelled strings: random strings are drawn with a fixed seed from the usual alphabets. Ordinary identifiers are the
words of all documents (runs of less than 20 token characters), and every two words with one space between them
joined by _, - or /, and by a capital. All documents are counted, each for itself; so the counts don't depend on the
order or batches of rows. The counts have one cell for each three symbols of the 68-symbol alphabet, 328,509 at most,
whatever the input. The threshold is where random strings that the model has not seen part from identifiers of three
words with the least sum of error rates (in the middle, if there is a gap). Those identifiers are every three
neighbouring words of every document, in each of the four joints; they are scored in place and counted by score, so
what is gathered has a row for each score that occurs, whatever the input. Ratios are whole millionths and scores
whole thousandths, so no sum depends on its order.

Spans are [start, end) in code points, sorted by start, then by kind in the order assign, access, hex, markov.

Cases: null or empty text: no spans; long texts: scanned whole; ties and repeated rows: every row alone, equal texts
give equal spans; empty table: empty result (and a model without ordinary counts, which is uniform); extra columns:
only the two named ones are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import table
from ._text import batches, give_back, texts

# Fixed patterns; the limits on length are applied to matches afterwards, as failing matches use up their text too.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run's match is the whole run, so the limit can stand in the pattern
KINDS = ("assign", "access", "hex", "markov")
LEAST = 20  # characters of a candidate
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")

SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
N = len(SYMBOLS) + 1  # and one for the edge of a run
CODE = np.zeros(256, np.int64)
CODE[[ord(c) for c in SYMBOLS]] = np.arange(1, N)
CAPITAL = np.arange(N)
CAPITAL[1:27] = np.arange(27, 53)
JOINTS = CODE[np.frombuffer(b"_-/", np.uint8)]
WORD = (CODE > 0) & (CODE <= 62)  # letters and digits, of which an identifier's words are made
LONGEST = 64  # characters of a labelled identifier's words; the least is LEAST
#: bytes counted at once; a longer document is cut where no word and no pair of words is cut
STEP = 1 << 19


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "key")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def cell(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A symbol with the two before it (0: none) as one number."""
    return (np.where(b > 0, a, 0) * N + b) * N + c


def cells(codes: np.ndarray) -> np.ndarray:
    """Each symbol with the two before it, as one number."""
    x = np.concatenate([[0, 0], codes])
    return cell(x[:-2], x[1:-1], codes)


def ordinary_cells(data: np.ndarray) -> np.ndarray:
    """Cells of the words of a text, and of the joints between neighbours."""
    codes = np.concatenate([[0, 0], CODE[data], [0, 0, 0]])
    edge = np.flatnonzero(np.diff((codes > 0).astype(np.int8))) + 1
    a, z = edge[::2], edge[1::2]
    long = z - a >= LEAST  # what may be a secret is no ordinary sample
    if long.any():
        gone = np.zeros(len(codes) + 1, np.int64)
        gone[a[long]] += 1
        gone[z[long]] -= 1
        codes[np.cumsum(gone)[:-1] > 0] = 0
    out = [cell(codes[:-2], codes[1:-1], codes[2:])[codes[2:] > 0]]
    k = np.flatnonzero(data == 0x20) + 2
    k = k[(codes[k - 1] > 0) & (codes[k + 1] > 0)]
    x, y, p, q, r = codes[k - 2], codes[k - 1], codes[k + 1], codes[k + 2], codes[k + 3]
    for joint in JOINTS:
        sign = np.full(len(k), joint)
        out += [cell(x, y, sign), cell(y, sign, p), cell(sign, p, q)[q > 0]]
    up = CAPITAL[p]
    out += [cell(x, y, up), cell(y, up, q)[q > 0], cell(up, q, r)[(q > 0) & (r > 0)]]
    return np.concatenate(out)


def identifier(text: str, at: int) -> str | None:
    """A labelled identifier: three neighbouring words (from a place given by a number on), joined in one of four ways."""
    found = [m.span() for m in re.finditer(r"[A-Za-z0-9]+", text)]
    sound = [i for i in range(len(found) - 2) if found[i][1] + 1 == found[i + 1][0] and found[i + 1][1] + 1 == found[i + 2][0] and text[found[i][1]] == text[found[i + 1][1]] == " "]
    sound = [i for i in sound if LEAST <= sum(e - s for s, e in found[i : i + 3]) <= LONGEST]
    if not sound:
        return None
    i = sound[at % len(sound)]
    w = [text[s:e] for s, e in found[i : i + 3]]
    return w[0] + "".join(x[:1].upper() + x[1:] for x in w[1:]) if at % 4 == 3 else "_-/"[at % 4].join(w)


def identifier_scores(data: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Scores of all labelled identifiers of a text: every three neighbouring words, joined in each of four ways."""
    codes, word = CODE[data], WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], word, [0]]).astype(np.int8)))
    a, z = edge[::2], edge[1::2]
    if len(a) < 3:
        return np.zeros(0, np.int64)
    joined = (a[1:] == z[:-1] + 1) & (data[z[:-1]] == 0x20)
    space = z[:-1][joined]
    size = z - a
    n = size[:-2] + size[1:-1] + size[2:]
    i = np.flatnonzero(joined[:-1] & joined[1:] & (n >= LEAST) & (n <= LONGEST))
    n, out = n[i], []
    s, e = a[i], z[i + 2]
    first = codes[s]
    zero = np.zeros(len(i), np.int64)
    # a symbol counts with the two before it, whatever identifier they are in; only a first word's start is alone
    for joint in JOINTS:
        x = codes.copy()
        x[space] = joint
        sums = np.concatenate([[0], np.cumsum(ratio[cells(x)], dtype=np.int64)])
        total = sums[e] - sums[s + 2] + ratio[cell(zero, zero, first)] + ratio[cell(zero, first, x[s + 1])]
        out.append(total // (1000 * (n + 2)))
    x = codes.copy()
    x[space + 1] = CAPITAL[x[space + 1]]
    keep = np.ones(len(x), bool)
    keep[space] = False
    s = s - np.searchsorted(space, s)
    x = x[keep]
    sums = np.concatenate([[0], np.cumsum(ratio[cells(x)], dtype=np.int64)])
    second, third = x[s + 1], x[s + 2]
    total = sums[s + n] - sums[s + 3] + ratio[cell(zero, zero, first)] + ratio[cell(zero, first, second)] + ratio[cell(first, second, third)]
    return np.concatenate([*out, total // (1000 * n)])


def random_strings(n: int, seed: int) -> list[str]:
    """Labelled samples: hexadecimal, base 32, base 62 and base 64 strings of 20 to 64 characters."""
    rng = np.random.default_rng(seed)
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", SYMBOLS[:62], SYMBOLS[:62] + "+/", SYMBOLS[:62] + "_-"]
    return ["".join(rng.choice(list(alphabets[i % len(alphabets)]), rng.integers(20, 65))) for i in range(n)]


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each cell, each order smoothed towards the one below it."""
    c = counts.reshape(N, N, N).astype(np.float64)
    low = c.sum((0, 1))
    p0 = (low + 1) / (low.sum() + N)
    two = c.sum(0)
    p1 = (two + 8 * p0) / (two.sum(1, keepdims=True) + 8)
    p2 = (c + 4 * p1[None]) / (c.sum(2, keepdims=True) + 4)
    return np.log(p2).ravel()


def parting(above: np.ndarray, below: np.ndarray, times: np.ndarray) -> float:
    """The threshold of the least sum of both error rates; in the middle between the nearest values.

    below: different values in order; times: how often each occurs.
    """
    at = np.unique(np.concatenate([above, below]))
    cuts = np.concatenate([[at[0]], (at[1:] + at[:-1]) / 2])
    lower = np.concatenate([[0], np.cumsum(times)])[np.searchsorted(below, cuts)]
    loss = np.searchsorted(np.sort(above), cuts) / len(above) + 1 - lower / times.sum()
    return float(cuts[np.argmin(np.round(loss, 9))])


@dataclass
class SecretScan:
    ratio: np.ndarray | None = None  # log-likelihood ratio of each cell, random over ordinary, in millionths
    threshold: float = 0.0  # in thousandths

    @staticmethod
    def segments(column: pa.Array) -> Iterator[np.ndarray]:
        """Bytes of whole documents, a line feed between them, in parts of about STEP bytes."""
        col = texts(column)
        if col.buffers()[2] is None:
            return
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]]
        data = np.insert(data, off[1:-1] - off[0], 10)
        at = 0
        while at < len(data):
            end = at + STEP
            while end < len(data):  # a cut stands at a byte that is in no word and joins no words
                part = data[end : end + STEP]
                free = np.flatnonzero((CODE[part] == 0) & (part != 0x20))
                if len(free):
                    end += int(free[0])
                    break
                end += STEP
            yield data[at:end]
            at = end

    @classmethod
    def count_rows(cls, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of all texts; at most N**3 rows for each task."""
        n = np.zeros(N**3, np.int64)
        for b in batches(it, 2000):
            for part in cls.segments(b.column(0)):
                n += np.bincount(ordinary_cells(part), minlength=N**3)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["cell", "n"])

    def identifier_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """score, n: how many labelled identifiers of all texts have it; a row at most for each score."""
        least = int(self.ratio.min()) // 1000
        n = np.zeros(int(self.ratio.max()) // 1000 - least + 1, np.int64)
        for b in batches(it, 2000):
            for part in self.segments(b.column(0)):
                n += np.bincount(identifier_scores(part, self.ratio) - least, minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at + least), pa.array(n[at])], ["score", "n"])
        give_back()

    @classmethod
    def fit(cls, df: DataFrame, text: str) -> SecretScan:
        rows = df.select(df[text].cast("string").alias("text")).mapInArrow(cls.count_rows, "cell int, n long")
        got = rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        ordinary = np.zeros(N**3)
        ordinary[got["cell"].to_numpy(int)] = got["n"]
        rand = np.zeros(N**3)
        codes = [CODE[np.frombuffer(s.encode(), np.uint8)] for s in random_strings(8000, 7)]
        for c in codes[::2]:
            np.add.at(rand, cells(c), 1)
        model = cls(np.round((log_model(rand) - log_model(ordinary)) * 1e6).astype(np.int32))
        unseen = np.array([model.ratio[cells(c)].sum(dtype=np.int64) // (1000 * len(c)) for c in codes[1::2]])
        names = df.select(df[text].cast("string").alias("text")).mapInArrow(model.identifier_rows, "score long, n long")
        names = names.groupBy("score").agg(F.sum("n").alias("n")).toPandas().sort_values("score")
        model.threshold = parting(unseen, names["score"].to_numpy(np.int64), names["n"].to_numpy(np.int64)) if len(names) else float(np.quantile(unseen, 0.02))
        return model

    def score(self, run: str) -> int:
        """Mean log-likelihood ratio of a run of token characters, in whole thousandths."""
        return int(self.ratio[cells(CODE[np.frombuffer(run.encode(), np.uint8)])].sum(dtype=np.int64) // (1000 * len(run)))

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, kind, end), sorted."""
        if not text:
            return []
        out = base_spans(text)
        if self.ratio is not None:
            more = []
            for m in CANDIDATE.finditer(text):
                s, e = m.span()
                for a, _, z in [*(x for x in out if x[0] < e and s < x[2]), (e, 0, e)]:  # what base spans leave of the run
                    if a - s >= LEAST and self.score(text[s:a]) >= self.threshold:
                        more.append((s, 3, a))
                    s = max(s, z)
            out = sorted(out + more)
        return out

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for b in batches(it, 3000):
            found = [[{"kind": KINDS[k], "start": s, "stop": e} for s, k, e in self.spans(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["key", "spans"])

    def __call__(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """key and spans (array of kind, start, stop) of each row."""
        two = df.select(df[key].cast("long").alias("key"), df[text].cast("string").alias("text"))
        return two.mapInArrow(self.rows, "key long, spans array<struct<kind: string, start: long, stop: long>>")

    def redacted(self, text: str | None) -> str | None:
        """The text with every secret replaced by its kind; overlapping spans by the first one's."""
        if not text:
            return text
        out, at = [], 0
        for s, k, e in self.spans(text):
            if s >= at:
                out += [text[at:s], f"[{KINDS[k]} removed]"]
            at = max(at, e)
        return "".join([*out, text[at:]])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' secrets."""
    docs = table(spark, sf_dir, "documents")
    out = SecretScan.fit(docs, "text")(docs, "doc_id", "text")
    base = F.filter("spans", lambda x: x["kind"] != "markov")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return out.select(
        F.col("key").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
