"""Image models as pluggable table functions, with deterministic stand-ins that are joins.

A model is a function over DataFrames: diagnose(figs) -> figure_id, defects, points; segment(figs, prompted) -> masks;
read(figs) -> annotations, scales, orientation. Real models go through `call_model`, which reads recorded answers
first and calls the service only for the rest, with retries inside the partition.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.materialize import materialized

REPLAY = "replay_key string, response string"


class Models(Protocol):
    def classify(self, figs: DataFrame) -> DataFrame: ...
    def confirm_text(self, texts: DataFrame) -> DataFrame: ...
    def diagnose(self, figs: DataFrame) -> DataFrame: ...
    def segment(self, figs: DataFrame, prompted: bool = False) -> DataFrame: ...
    def read(self, figs: DataFrame) -> tuple[DataFrame, DataFrame]: ...


class Compositor(Protocol):
    def __call__(self, pairs: DataFrame, files: DataFrame) -> DataFrame: ...


class ReviewBridge(Protocol):
    def create_tasks(self, events: DataFrame) -> DataFrame: ...


@dataclass
class MockModels:
    """Answers from ground: figure_id, seqs array<string>, and optionally inject_defects array<string>,
    inject_incomplete boolean, points array<string>."""

    ground: DataFrame

    def _of(self, figs: DataFrame, column: str, kind: str) -> DataFrame:
        g = self.ground if column in self.ground.columns else self.ground.withColumn(column, F.lit(None).cast(kind))
        return figs.select("figure_id").join(g.select("figure_id", F.col(column).alias("x")), "figure_id", "left")

    def classify(self, figs: DataFrame) -> DataFrame:
        return self._of(figs, "image_type", "string").select("figure_id", F.coalesce("x", F.lit("discarded")).alias("image_type"), F.lit(0.9).alias("confidence"))

    def diagnose(self, figs: DataFrame) -> DataFrame:
        none = F.array().cast("array<string>")
        d = self._of(figs, "inject_defects", "array<string>").select("figure_id", F.coalesce("x", none).alias("defects"))
        return d.join(self._of(figs, "points", "array<string>").select("figure_id", F.coalesce("x", none).alias("points")), "figure_id")

    def confirm_text(self, texts: DataFrame) -> DataFrame:
        return texts.withColumn("accepted", F.lit(True)).withColumn("confidence", F.lit(0.9))

    def segment(self, figs: DataFrame, prompted: bool = False) -> DataFrame:
        """A mask for each number, one numbered 1 where there is none."""
        some = F.when(F.size(F.coalesce("x", F.array().cast("array<string>"))) > 0, F.col("x")).otherwise(F.array(F.lit("1")))
        bad = self._of(figs, "inject_incomplete", "boolean").select("figure_id", (F.coalesce("x", F.lit(False)) & F.lit(not prompted)).alias("incomplete"))
        m = self._of(figs, "seqs", "array<string>").select("figure_id", F.posexplode(some).alias("mask_ord", "seq")).join(bad, "figure_id")
        box = F.struct((F.col("mask_ord") * 10).alias("x"), F.lit(10).alias("y"), F.lit(100).alias("w"), F.lit(100).alias("h"))
        return m.select("figure_id", "mask_ord", F.concat_ws("-", F.lit("rle"), "figure_id", "seq").alias("mask_rle"), box.alias("bbox"), F.lit(10000).alias("area"), "seq", F.lit(2).alias("scale_level"), "incomplete")

    def read(self, figs: DataFrame) -> tuple[DataFrame, DataFrame]:
        seqs = self._of(figs, "seqs", "array<string>").select("figure_id", F.posexplode("x").alias("ord", "text"))
        scales = figs.select("figure_id", F.lit(0).alias("ord"), F.lit("0-8厘米").alias("text"), F.lit(None).cast("string").alias("seq_ref"))
        return seqs, scales


class NoModels:
    """Any use is an error: what runs offline has no model in its plan."""

    def __getattr__(self, name: str):
        raise RuntimeError(f"model call in an offline plan: {name}")


def image_annotations(models: Models, figs: DataFrame) -> DataFrame:
    """figure_id, ocr, scales, orientation (the model's, if its annotations tell one; else h)."""
    seqs, scales = models.read(figs)
    told = F.first("orientation", ignorenulls=True) if "orientation" in seqs.columns else F.lit(None).cast("string")
    a = seqs.groupBy("figure_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]).alias("ocr"), told.alias("orientation"))
    b = scales.groupBy("figure_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "seq_ref"))), lambda x: F.struct(x["seq_ref"].alias("seq_ref"))).alias("scales"))
    out = figs.select("figure_id").join(a, "figure_id", "left").join(b, "figure_id", "left")
    return out.select("figure_id", F.coalesce("ocr", F.array().cast("array<string>")).alias("ocr"), F.coalesce("scales", F.array().cast("array<struct<seq_ref:string>>")).alias("scales"), F.coalesce("orientation", F.lit("h")).alias("orientation"))


def with_retries(call: Callable[[str], str], retryable: tuple = (TimeoutError, ConnectionError), tries: int = 3, qps: float = 0.0, sleep: Callable = time.sleep) -> Callable[[str], str]:
    """call, at most tries times on errors that may pass (by type, or as they say), at most qps times a second (0: no limit)."""
    last = [0.0]

    def guarded(request: str) -> str:
        for k in range(tries):
            if qps:
                sleep(max(0.0, last[0] + 1 / qps - time.monotonic()))
                last[0] = time.monotonic()
            try:
                return call(request)
            except Exception as e:
                if k + 1 == tries or not (isinstance(e, retryable) or getattr(e, "retryable", False)):
                    raise
                sleep(min(0.5 * 2**k, 5.0))
        raise AssertionError

    return guarded


def call_model(requests: DataFrame, recorded: DataFrame, make_call: Callable[[], Callable[[str], str]], qps: float = 0.0, tasks: int = 1, log: str | None = None) -> DataFrame:
    """requests (service, operation, figure_id, iteration, request) with response, error and replayed.

    Each key is asked once: recorded answers are joined, only the others reach the model, by `tasks` tasks that share
    qps calls a second (0: no limit, and as many tasks as there are partitions). Answers are kept before anything is
    made of them, so a lost executor doesn't ask again; with `log`, a table of recorded answers grows by them. An
    error that stays keeps its own code, if it has one; else it is E1000.
    """
    keyed = requests.withColumn("replay_key", T.joined_key(F.col("service"), F.col("operation"), F.col("figure_id"), F.col("iteration")))
    known = recorded.groupBy("replay_key").agg(F.min("response").alias("response"))
    hits = known.select("replay_key", "response", F.lit(None).cast("string").alias("error"), F.lit(True).alias("replayed"))

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = with_retries(make_call(), qps=qps / tasks)
        for b in it:
            out = []
            for key, request in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    out.append((key, call(request), None, False))
                except Exception as e:
                    out.append((key, None, str(getattr(e, "code", "E1000")), False))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_())], ["replay_key", "response", "error", "replayed"])

    misses = keyed.join(known.select("replay_key"), "replay_key", "left_anti").groupBy("replay_key").agg(F.min("request").alias("request"))
    misses = misses.repartition(tasks, "replay_key") if qps else misses
    live = materialized(misses.mapInArrow(rows, "replay_key string, response string, error string, replayed boolean"))
    if log:
        live.where("error is null").select("replay_key", "response").write.mode("append").parquet(log)
    return keyed.join(hits.unionByName(live), "replay_key")
