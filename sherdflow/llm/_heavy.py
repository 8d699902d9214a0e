"""Heavy hitters by share, whose number is bounded by construction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Only hashes with at least this share of all occurrences are kept, so there are at most SHARE of them.
SHARE = 1 << 17
LEAST = 16


def local_counts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (as signed) and counts worth telling: a hash over the global share is over half of it somewhere."""
    value, count = np.unique(h, return_counts=True)
    keep = count >= max(2, len(h) // (2 * SHARE))
    return value[keep].view(np.int64), count[keep]


def heavy(counts: DataFrame, total: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes (unsigned) and counts with at least 1/SHARE of `total`; counts: (kind, h, n)."""
    least = max(LEAST, total // SHARE)
    rows = counts.where(F.col("kind") == kind).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    pdf = rows.toPandas()
    h = pdf["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], pdf["n"].to_numpy(np.int64)[order]
