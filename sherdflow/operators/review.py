"""Supervision rounds, the decision to review, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_ITERATION = 3


def rounds(defects: DataFrame, key: str = "figure_id", order: tuple = ("round",), max_iteration: int = MAX_ITERATION, loop: bool = True) -> DataFrame:
    """Rounds (key, order..., n_defects) with converged, no_improve, iteration, escalation.

    No improvement: defects are left and not fewer than in the round before. A round that neither converges nor
    fails to improve moves the iteration on, up to the limit.
    """
    w = W.partitionBy(key).orderBy(*order)
    out = defects.withColumn("converged", F.col("n_defects") == 0)
    out = out.withColumn("no_improve", F.coalesce(~F.col("converged") & (F.col("n_defects") >= F.lag("n_defects").over(w)), F.lit(False)))
    moved = (~F.col("converged") & ~F.col("no_improve") & F.lit(loop)).cast("int")
    out = out.withColumn("iteration", F.least(F.lit(max_iteration), F.sum(moved).over(w.rowsBetween(W.unboundedPreceding, 0))).cast("int"))
    return out.withColumn("escalation", F.least(F.col("iteration") + 1, F.lit(3)))


def action_params(n_defects: Column, escalation: Column) -> Column:
    """What a further try is given."""
    return F.when(n_defects > 0, F.struct((escalation >= 2).alias("few_shot"), F.when(escalation >= 3, "high").alias("model_tier")))


def pending(alarms: Column, no_improve: Column, case: Column, degraded: Column, has_evidence: Column, last_defects: Column, iteration: Column, max_iteration: int = MAX_ITERATION) -> Column:
    """Whether a figure goes to review."""
    return (F.size(alarms) > 0) | no_improve | ((case == "seq_missing") & ~degraded) | (degraded & ~has_evidence) | ((last_defects > 0) & (iteration >= max_iteration))


def idempotent_tasks(events: DataFrame, key: str = "event_id", order: tuple = ("ts",)) -> DataFrame:
    """The first of all events with one id."""
    return events.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def throttled(calls: DataFrame, service: str, ts: str, qps: int, tie: str) -> DataFrame:
    """Calls with `over`: beyond qps in their second; 0 means no limit."""
    second = F.date_trunc("second", F.col(ts))
    k = F.row_number().over(W.partitionBy(service, second).orderBy(ts, tie))
    return calls.withColumn("over", F.lit(qps > 0) & (k > qps))


def last_calls(log: DataFrame, n: int = 10_000, order: tuple = ("ts",)) -> DataFrame:
    """The newest n entries of a log."""
    return log.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def status_by_type(figs: DataFrame, statuses: tuple) -> DataFrame:
    """A row for each image type, a count for each status."""
    return figs.groupBy("image_type").pivot("status", list(statuses)).count().na.fill(0)


def corpus_totals(figs: DataFrame, pairs: DataFrame, violations: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """book, total, books, figures, pairs, violations, statuses (`status=count`, in order) of each book, and of all in
    the row where total is true. A book counts if any of the tables names it (books: those without any figure)."""
    none = F.lit(None).cast("string")
    status = F.col("status") if "status" in figs.columns else none
    row = lambda df, x, s: df.select("book", *(F.lit(int(c == x)).cast("long").alias(c) for c in ("figures", "pairs", "violations")), s.alias("status"))
    rows = row(figs, "figures", status).unionByName(row(pairs, "pairs", none)).unionByName(row(violations, "violations", none))
    if books is not None:
        rows = rows.unionByName(row(books, "", none))
    sums = [F.sum(c).alias(c) for c in ("figures", "pairs", "violations")]
    per = rows.groupBy("book", "status").agg(*sums)
    per = per.withColumn("books", F.lit(0).cast("long")).unionByName(per.groupBy("book").agg(*(F.lit(0).cast("long").alias(c) for c in ("figures", "pairs", "violations")), F.lit(1).cast("long").alias("books")).withColumn("status", none))
    per = per.withColumn("total", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("book", F.when(~F.col("total"), F.col("book")))
    per = per.groupBy("total", "book", "status").agg(F.sum("books").alias("books"), *sums)
    told = F.array_sort(F.collect_list(F.when(F.col("status").isNotNull(), F.concat("status", F.lit("="), F.col("figures").cast("string")))))
    return per.groupBy("book", "total").agg(F.sum("books").alias("books"), *sums, F.array_join(told, ",").alias("statuses"))


def conformance_metrics(elements: DataFrame, associated: DataFrame) -> DataFrame:
    """book and what its score is made of: figures, captions and notes as marked up, and as they were found."""
    n = lambda x, name: F.sum(F.coalesce(x, F.lit(False)).cast("long")).alias(name)
    fig, filled = F.col("tag") == "figure", lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    note = (F.col("tag") == "para") & (F.col("role") == "figure-note") & filled("text")
    marked = elements.where("tag != '#error'").groupBy("book").agg(
        n(fig, "nfig"), n(fig & filled("caption"), "cap_role"), n(note, "note"), n(fig & F.col("has_media"), "im"), n(fig & F.col("has_media") & filled("w") & filled("h"), "im_dims")
    )
    noted, titled = F.col("has_media") & F.col("figure_note").isNotNull(), F.col("has_media") & F.col("caption").isNotNull()
    found = associated.groupBy("book").agg(n(noted, "rel_note"), n(titled, "rel_cap"), n(noted & titled, "both"), n(~F.col("has_media") | F.col("caption").isNull(), "viol"))
    return marked.join(found, "book", "left").na.fill(0)


def conformance(books: DataFrame) -> DataFrame:
    """Adds score: how well a book's markup keeps the input contract, 0 to 100; best first, unknown books last."""
    part = lambda n, d: F.col(n) / F.greatest(F.col(d), F.lit(1))
    s = 20 * part("cap_role", "nfig") + 20 * part("note", "nfig") + 15 * part("rel_note", "nfig") + 15 * part("both", "nfig") + 10 * part("rel_cap", "nfig") + 10 * part("im_dims", "im") - 5 * part("viol", "nfig")
    return books.withColumn("score", F.when(F.col("nfig") > 0, F.round(F.greatest(F.lit(0.0), s), 1)).when(F.col("nfig") == 0, 0.0)).orderBy(F.desc_nulls_last("score"), "book")
