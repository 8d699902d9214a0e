"""What keeps the report queries in proportion to their input."""

import random

import pytest
from pyspark.sql import functions as F

from sherdflow.functions import notes as N
from sherdflow.operators import assemble as A
from sherdflow.plans import derived as D
from sherdflow.plans import queries as Q

from .native_notes import note_items

SF = "/root/testdata/sf0.001"
BITS = [
    "1. 豆（M4:1）", "3. big ax（MT4:1、T7：2） ", "12、壶(A1:3)", "1", "13", "0", " ", ".", "、", ",", "~", "～", ":", "：", "∶", "（", "）", "(", ")", "$", r"\sim", "①", "⑩", "⑳",
    "M4:1", "00FBG1:2", "1.98XDT2:6", "A", "B.", "Qxc42", "Abc12:3", "H83①:35", "陶壶", "厘米", "-", "é", "\u0301", "Ⓐ", "\u200c", "\u3000", "\n", "\x85", "\x1c", "²", "ß", "_", "𠀀", "9999999999", "3~1", "1~3", "z",
]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reader_equals_columns(spark):
    r = random.Random(3)
    df = spark.createDataFrame([("".join(r.choice(BITS) for _ in range(r.randint(1, 12))),) for _ in range(1500)] + [(None,), ("",)], "n string")
    bad = df.select("n", N.note_items(F.col("n")).alias("a"), note_items(F.col("n")).alias("b")).where("not (a <=> b)")
    assert [r["n"] for r in bad.collect()] == []


@pytest.mark.parametrize("name", ["note_roundtrip", "note_names", "image_types", "status_by_image_type", "single_pairs", "case_and_confidence", "alarms_and_conflicts", "pending_review", "multi_pairs"])
def test_notes_are_read_once(spark, name):
    """By one Python step, after one shuffle of the items; no filter or second use reads them again."""
    p = plan(Q.QUERIES[name](spark, SF))
    assert p.count("ArrowEvalPython") == 1 and p.count("l_orderkey#") > 0 and p.count("RepartitionByExpression") == (2 if name == "multi_pairs" else 1)


def test_items_of_unknown_parts_stay(spark, tmp_path):
    spark.createDataFrame([(1, 2, 7), (1, 1, 8), (1, 2, 9), (1, 2, 7)], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(7, "b ring"), (9, "a ring")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    assert [r["figure_note"] for r in D.notes(spark, str(tmp_path)).collect()] == ["1. （M1:8） 2. a ring（M1:7、M1:9）"]
    got = {(r["seq"], r["name"], r["n_ids"]) for r in Q.note_names(spark, str(tmp_path)).collect()}
    assert got == {("1", None, 1), ("2", "a ring", 2)}


def test_multi_pairs_reads_figures_once(spark):
    f = spark.createDataFrame([("b", "f1", 1, "m/f1.png", "图1", "rule_a", []), ("b", "f2", 2, "m/f2.png", "图1", "rule_b", ["C:1"]), ("b", "f3", 3, "m/f3.png", "图3", "rule_a", [])], "book string, figure_id string, figure_ord int, fileref string, caption string, case_type string, caption_artifacts_used array<string>")
    m = spark.createDataFrame([("f1", 0, "1"), ("f1", 1, "1"), ("f2", 0, "1"), ("f3", 0, "1"), ("f3", 1, "9")], "figure_id string, mask_ord int, seq string")
    p = spark.createDataFrame([("f1", "1", "A:1", 0), ("f1", "1", "A:2", 1), ("f3", "1", "A:3", 0)], "figure_id string, seq string, artifact_id string, art_ord int")
    t = spark.createDataFrame([("f1", "A:2", "two")], "figure_id string, artifact_id string, description_text string")
    out = A.multi_pairs(f, m, p, t)
    assert plan(out).count("LogicalRDD") == 4
    got = sorted((r["figure_id"], r["rec_ord"], r["artifact_id"], r["seq"], r["views"], r["image_path"], r["description_text"]) for r in out.collect())
    assert got == [("f1", 1, "A:1", "1", 1, "图1_1_A-1.png", None), ("f1", 2, "A:2", "1", 1, "图1_1_A-2.png", "two"), ("f1", 3, "A:1", "1", 1, "图1_1_A-1_1.png", None), ("f1", 4, "A:2", "1", 1, "图1_1_A-2_1.png", "two"), ("f2", 1, "C:1", None, 1, "图1_01_C-1.png", None)]
