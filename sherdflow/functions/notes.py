"""Figure notes and body paragraphs as table-generating steps over DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import reader
from . import text as T

ITEM = "struct<seq:string,seq_list:array<int>,name:string,artifact_ids:array<string>>"


def note_items(note: Column) -> Column:
    """array<ITEM>: an entry for each sequence head that leads to a name or to ids; none for null.

    Python reads a batch in one pass. The column counts as nondeterministic, so that no filter or projection above it
    reads the notes again.
    """
    return F.arrow_udf(reader.read, f"array<{ITEM}>").asNondeterministic()(note)


def with_note_items(df: DataFrame, note: str, out: str = "note_items") -> DataFrame:
    return df.withColumn(out, note_items(F.col(note)))


#: named ways to read notes: (DataFrame, note column, output column) -> DataFrame
NOTE_PARSERS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {"rule": with_note_items}


def register(name: str) -> Callable:
    def add(parser: Callable) -> Callable:
        NOTE_PARSERS[name] = parser
        return parser

    return add


def parse_notes(df: DataFrame, note: str, out: str = "note_items", strategy: str = "rule") -> DataFrame:
    return NOTE_PARSERS[strategy](df, note, out)


def item_seqs(items: Column) -> Column:
    """All sequence numbers of note items, as strings: the expanded list, or the head where there is none."""
    return F.flatten(F.transform(items, lambda x: F.when(F.size(x["seq_list"]) > 0, x["seq_list"].cast("array<string>")).otherwise(F.array(x["seq"]))))


def item_artifacts(items: Column) -> Column:
    return F.flatten(F.transform(items, lambda x: x["artifact_ids"]))


def artifact_count(items: Column, caption: Column) -> Column:
    """Distinct ids of the note; of the caption where the note has none."""
    of_note = F.array_distinct(item_artifacts(items))
    return F.when(F.size(of_note) > 0, F.size(of_note)).otherwise(F.size(T.caption_artifacts(caption)))


def split_body(paras: DataFrame, scope: list[str], order: str, para_id: str = "id", text: str = "text") -> DataFrame:
    """Text segments by artifact: scope..., artifact_id, text, source_para_ids, markers, confidence, para_ord, seg_ord.

    A paragraph with one id is its text whole; with several it is cut at each id; with none it goes to the last id
    met before it in its scope, if any.
    """
    rows = paras.select(*scope, F.col(order).alias("para_ord"), F.col(para_id).alias("id"), F.col(text).alias("raw"))
    norm = T.aligned(F.col("raw"))
    cut_id = lambda s: T.colon_norm(T.cut(F.col("raw"), s["start"], s["stop"]))
    # spans are for paragraphs with several ids only; what goes through the window is narrow
    rows = rows.withColumn("hits", F.regexp_extract_all(norm, F.lit(T.ARTIFACT), F.lit(0))).withColumn("n", F.size("hits"))
    rows = rows.withColumn("ids", F.when(F.col("n") > 1, T.spans(norm, T.ARTIFACT)))
    first = F.char_length(F.get(F.split(norm, T.ARTIFACT, 2), F.lit(0)))
    only = T.colon_norm(T.cut(F.col("raw"), first, first + F.char_length(F.get("hits", F.lit(0)))))
    rows = rows.withColumn("last_id", F.when(F.col("n") == 1, only).when(F.col("n") > 1, cut_id(F.element_at("ids", -1)))).drop("hits")
    before = W.partitionBy(*scope).orderBy("para_ord").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("carried", F.last("last_id", ignorenulls=True).over(before))
    none = F.array().cast("array<string>")

    def entry(art: Column, text: Column, markers: Column, confidence: float) -> Column:
        return F.struct(art.alias("artifact_id"), text.alias("text"), markers.alias("markers"), F.lit(confidence).alias("confidence"))

    def segment(s: Column, i: Column) -> Column:
        end = F.coalesce(F.get(F.col("ids"), i + 1)["start"], F.char_length("raw"))
        return entry(cut_id(s), T.strip(T.cut(F.col("raw"), s["start"], end)), F.array(F.lit("multi_anchor")), 0.8)

    marker = F.when(norm.rlike(T.PIECES), "piece_count").when(norm.rlike(T.FIGURE_REF), "fig_ref").otherwise("no_anchor")
    loose = F.when(F.col("carried").isNotNull(), F.array(entry(F.col("carried"), F.col("raw"), F.array(marker), 0.6)))
    segments = F.when(F.col("n") > 1, F.transform("ids", segment)).when(F.col("n") == 1, F.array(entry(F.col("last_id"), F.col("raw"), none, 0.95))).otherwise(loose)
    # outer: an inner one gets a filter that makes the segments a second time
    out = rows.select(*scope, "para_ord", "id", F.posexplode_outer(segments).alias("seg_ord", "s")).where("s.artifact_id is not null")
    return out.select(*scope, "s.artifact_id", "s.text", F.array("id").alias("source_para_ids"), "s.markers", "s.confidence", "para_ord", "seg_ord")


def describe(segments: DataFrame, scope: list[str]) -> DataFrame:
    """The last text of each artifact in its scope."""
    return segments.groupBy(*scope, "artifact_id").agg(F.max_by("text", F.struct("para_ord", "seg_ord")).alias("description_text"))
