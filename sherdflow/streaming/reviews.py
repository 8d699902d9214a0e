"""Streams of review events, model calls and supervision rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def tasks(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One event for each event_id, however often it is sent within the delay. events: event_id, ts, ..."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def resume(callbacks: DataFrame, pending: DataFrame) -> DataFrame:
    """Decisions (event_id, decision) onto waiting figures: a stream joined with a table."""
    return callbacks.join(pending, "event_id").select("figure_id", "event_id", F.when(F.col("decision") == "accept", "OUTPUT").otherwise("EXCLUDED").alias("status"))


def calls_per_second(calls: DataFrame, qps: int, delay: str = "10 seconds") -> DataFrame:
    """service, second, calls, over: how many came and how many were too many."""
    n = calls.withWatermark("ts", delay).groupBy("service", F.window("ts", "1 second").alias("w")).agg(F.count("*").alias("calls"))
    return n.select("service", F.col("w.start").alias("second"), "calls", F.greatest(F.lit(0), F.col("calls") - qps if qps else F.lit(0)).alias("over"))


ROUNDS = "figure_id string, round long, n_defects long, iteration long, no_improve boolean, next string"
STATE = "iteration long, last long, round long"


def supervise(rounds: DataFrame, max_iteration: int = 3) -> DataFrame:
    """Rounds (figure_id, round, n_defects) with the loop's state kept for each figure between batches."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        iteration, last, count = state.get if state.exists else (0, -1, 0)
        rows = pd.concat(list(frames)).sort_values("round")
        out = []
        for n in rows["n_defects"].tolist():
            count += 1
            stuck = n > 0 and last >= 0 and n >= last
            if n > 0 and not stuck and iteration < max_iteration:
                iteration += 1
            last = n
            done = n == 0 or stuck or iteration >= max_iteration
            out.append((key[0], count, n, iteration, stuck, "bridge_review" if done else "retry"))
        state.update((iteration, last, count))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ROUNDS.split(", ")])

    return rounds.groupBy("figure_id").applyInPandasWithState(step, ROUNDS, STATE, "append", GroupStateTimeout.NoTimeout)


def run_available(df: DataFrame, path: str, checkpoint: str):
    """Works off what is there and stops; a further call goes on from the checkpoint."""
    query = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
