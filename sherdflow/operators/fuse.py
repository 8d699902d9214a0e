"""Reconciliation of note items, text and image annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.notes import item_artifacts, item_seqs

# Confidence by which of note, text and image are there.
CONFIDENCE = {"111": 0.95, "110": 0.85, "101": 0.85, "100": 0.85, "011": 0.70, "010": 0.60, "001": 0.50}
CAPTION_FACTOR = 0.8


def pair_up(seqs: Column, arts: Column) -> Column:
    """array<struct<seq, artifact_id>> by position; one against many goes with each; other sizes pair nothing."""
    both = lambda s, a: F.struct(s.alias("seq"), a.alias("artifact_id"))
    empty = F.array().cast("array<struct<seq:string,artifact_id:string>>")
    return (
        F.when(F.size(seqs) == F.size(arts), F.zip_with(seqs, arts, both))
        .when(F.size(seqs) == 1, F.transform(arts, lambda a: both(F.element_at(seqs, 1), a)))
        .when(F.size(arts) == 1, F.transform(seqs, lambda s: both(s, F.element_at(arts, 1))))
        .otherwise(empty)
    )


def _seqs_of(item: Column) -> Column:
    return F.when(F.size(item["seq_list"]) > 0, item["seq_list"].cast("array<string>")).otherwise(F.array(item["seq"]))


def item_pairs(items: Column) -> Column:
    return F.flatten(F.transform(items, lambda x: pair_up(_seqs_of(x), x["artifact_ids"])))


def mismatches(items: Column) -> Column:
    """A conflict for each item whose numbers and ids pair nothing."""
    bad = F.filter(items, lambda x: (F.size(_seqs_of(x)) != F.size(x["artifact_ids"])) & (F.size(_seqs_of(x)) != 1) & (F.size(x["artifact_ids"]) != 1))
    return F.transform(bad, lambda x: F.concat(F.lit("seq_art_mismatch:seqs="), F.array_join(_seqs_of(x), ","), F.lit(",arts="), F.array_join(x["artifact_ids"], ",")))


def symmetric_difference(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(F.array_except(a, b), F.array_except(b, a)))


def case_of(items: Column) -> Column:
    multi = F.exists(items, lambda x: F.size(x["artifact_ids"]) > 1)
    ranged = F.exists(items, lambda x: x["seq"].contains("~"))
    one = (F.size(F.array_distinct(item_artifacts(items))) == 1) & (F.size(item_seqs(items)) > 1)
    return F.when(F.size(items) == 0, "seq_missing").when(multi & ranged, "range_split").when(multi, "split_same_seq").when(one, "rule_b").otherwise("rule_a")


def confidence(note: Column, text: Column, image: Column) -> Column:
    key = F.concat(*[F.when(x, "1").otherwise("0") for x in (note, text, image)])
    out = F.lit(0.5)
    for k, v in CONFIDENCE.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def alarms(note: Column, items: Column, ocr: Column, scales: Column, masks: Column) -> Column:
    """array of alarm codes. ocr: array<string>; scales: array<struct<seq_ref>>; masks: array<struct<incomplete>>."""
    said, seen = F.array_distinct(item_seqs(items)), F.array_distinct(ocr)
    known = F.array_union(said, seen)
    there = F.coalesce(note, F.lit("")) != ""
    named = F.filter(scales, lambda s: F.coalesce(s["seq_ref"], F.lit("")) != "")
    tests = {
        "E001": (F.size(items) > 0) & (F.size(seen) > 0) & (F.size(F.array_except(said, seen)) > 0),
        "E002": there & (F.size(seen) > 0) & (F.size(F.array_except(seen, said)) > 0),
        "E003": (F.size(named) >= 2) & F.exists(named, lambda s: ~F.array_contains(known, s["seq_ref"])),
        "E004": (F.size(named) < F.size(scales)) & (F.size(scales) >= 2),
        "E005": there & (F.size(said) == 0) & ((F.size(seen) > 1) | (F.size(masks) > 1)),
        "E006": F.exists(masks, lambda m: F.coalesce(m["incomplete"], F.lit(False))),
    }
    return F.array_compact(F.array(*[F.when(x, code) for code, x in tests.items()]))


def fuse(figs: DataFrame) -> DataFrame:
    """Adds pairs, case_type, confidence, conflicts, alarms, degraded, caption_artifacts_used.

    figs: figure_note, note_items, caption_artifacts, ocr (array<string>), scales, n_texts.
    """
    items, ocr = F.col("note_items"), F.col("ocr")
    empty_masks = F.array().cast("array<struct<incomplete:boolean>>")
    use = (F.size("caption_artifacts") > 0) & (F.size(item_artifacts(items)) == 0)
    figs = figs.withColumn("use_caption", use)
    said = F.array_distinct(item_seqs(items))
    whole = (F.size("caption_artifacts") == 1) & (F.size(said) <= 1)
    open_caption = F.col("use_caption") & ~whole
    figs = figs.withColumn("case_type", F.when(~F.col("use_caption"), case_of(items)).when(whole, "rule_b").otherwise("seq_missing"))
    found = alarms(F.col("figure_note"), items, ocr, F.col("scales"), empty_masks)
    figs = figs.withColumn("alarms", F.when(open_caption, F.array_union(found, F.array(F.lit("E005")))).otherwise(found))
    apart = F.when((F.size(items) > 0) & (F.size(ocr) > 0), symmetric_difference(said, F.array_distinct(ocr))).otherwise(F.array().cast("array<string>"))
    caption = F.when(open_caption, F.array(F.concat(F.lit("caption_multi_artifacts:"), F.array_join("caption_artifacts", ",")))).otherwise(F.array().cast("array<string>"))
    figs = figs.withColumn("conflicts", F.concat(mismatches(items), apart, caption)).withColumn("pairs", item_pairs(items))
    conf = confidence((F.size(items) > 0) | F.col("use_caption"), F.col("n_texts") > 0, F.size(ocr) > 0)
    figs = figs.withColumn("confidence", F.when(F.col("use_caption"), F.round(conf * CAPTION_FACTOR, 2)).otherwise(conf))
    figs = figs.withColumn("degraded", (F.size(items) == 0) & ((F.col("n_texts") > 0) | (F.size(ocr) > 0) | F.col("use_caption")))
    return figs.withColumn("caption_artifacts_used", F.when(F.col("use_caption"), F.col("caption_artifacts")).otherwise(F.array().cast("array<string>")))


def assign_scales(scales: Column, seqs: Column) -> Column:
    """array<struct<idx, owner>>: a single scale is shared, others belong to the number they name."""
    one = F.array(F.struct(F.lit(0).alias("idx"), F.lit("shared").alias("owner")))
    each = F.transform(scales, lambda s, i: F.struct(i.alias("idx"), F.when(F.array_contains(seqs, s["seq_ref"]), s["seq_ref"]).alias("owner")))
    return F.when(F.size(scales) == 1, one).otherwise(F.filter(each, lambda x: x["owner"].isNotNull()))


def scale_level(seq: Column, owners: Column) -> Column:
    names = F.transform(owners, lambda x: x["owner"])
    return F.when(F.array_contains(names, seq), 1).when(F.array_contains(names, "shared"), 2).otherwise(3)


def mask_regions(masks: DataFrame, annotations: DataFrame, scales: DataFrame) -> DataFrame:
    """masks (figure_id, seq, scale_level) with text and scale regions that belong to them.

    annotations: figure_id, text, group, ord; scales: figure_id, text, seq_ref, ord.
    """
    m, a, s = masks.alias("m"), annotations.alias("a"), scales.alias("s")
    plain = F.regexp_replace(F.trim("a.text"), r"\.+$", "")
    own = (F.col("m.figure_id") == F.col("a.figure_id")) & ((plain == F.col("m.seq")) | F.coalesce(F.array_contains("a.group", F.col("m.seq")), F.lit(False)))
    key = ["figure_id", "seq"]
    listed = lambda t, name: F.transform(F.array_sort(F.collect_list(F.struct(f"{t}.ord", f"{t}.text"))), lambda x: x["text"]).alias(name)
    text = m.join(a, own).groupBy("m.figure_id", "m.seq").agg(listed("a", "text_regions"))
    mine = m.join(s, (F.col("m.figure_id") == F.col("s.figure_id")) & (F.col("s.seq_ref") == F.col("m.seq"))).groupBy("m.figure_id", "m.seq").agg(listed("s", "own_scales"))
    free = scales.where("coalesce(seq_ref, '') = ''").groupBy("figure_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]).alias("free_scales"))
    out = masks.join(text, key, "left").join(mine, key, "left").join(free, "figure_id", "left")
    none = F.array().cast("array<string>")
    shared = F.when(F.col("scale_level") == 2, F.coalesce("free_scales", none)).otherwise(none)
    return out.select(*masks.columns, F.coalesce("text_regions", none).alias("text_regions"), F.coalesce("own_scales", shared).alias("scale_regions"))


def rotation(orientation: Column, correct: bool = True) -> Column:
    return F.when(F.lit(correct) & (orientation == "v"), "cw")


def hard_mask_alarm(mask_rle: Column) -> Column:
    """A mask must be a mask."""
    return F.when(F.coalesce(mask_rle, F.lit("")) == "", "E007")
