"""Notes, figures, runs: the shapes that reports really have."""

import json

import pytest
from pyspark.sql import functions as F

from sherdflow.functions import notes as N
from sherdflow.functions import text as T
from sherdflow.operators import capability as P
from sherdflow.operators import classify as C
from sherdflow.operators import fuse as U
from sherdflow.plans import reports
from sherdflow.sources import config, docbook, store

NOTES = [
    ("1. 石斧", [([1], "石斧", [])]),
    ("1、2. 彩盆（T7:12、T7:9） 3. 玉环（T7:31）", [([1, 2], "彩盆", ["T7:12", "T7:9"]), ([3], "玉环", ["T7:31"])]),
    ("1～3. 钵（F2:8、F2:5、F2:6） 4. 瓮（F2:7）", [([1, 2, 3], "钵", ["F2:8", "F2:5", "F2:6"]), ([4], "瓮", ["F2:7"])]),
    ("0 15厘米", []),
    ("1. 纺轮（G52∶17）", [([1], "纺轮", ["G52:17"])]),
    ("1. 网坠（Y6③:28）", [([1], "网坠", ["Y6③:28"])]),
    ("1.98XDT2:6 2.98XDT2:4", [([1], None, ["98XDT2:6"]), ([2], None, ["98XDT2:4"])]),
    (r"$1\sim 3$ 彩盆 4.彩钵", [([1, 2, 3], "彩盆", []), ([4], "彩钵", [])]),
    ("1. 钵（F9:15、16） 2. 瓮（F9:17）", None),
    (None, []),
    ("", []),
]


def test_notes(spark):
    df = spark.createDataFrame([(k, n) for k, (n, _) in enumerate(NOTES)], "k int, note string")
    got = {r["k"]: [(i["seq_list"], i["name"], i["artifact_ids"]) for i in r["note_items"]] for r in N.parse_notes(df, "note").collect()}
    for k, (_, want) in enumerate(NOTES):
        if want is not None:
            assert [(list(a), b, list(c)) for a, b, c in got[k]] == want
    assert [list(c) for _, _, c in got[8]] == [["F9:15"], ["F9:17"]]  # the 16 begins inside an id's list, not a head


def test_captions_and_numbers(spark):
    rows = [("图8-3 出于T5的玉琮（T5：21）侧面",), ("图版十九 全景",), ("图一三O Qxc4 与 K2:7、K2:7",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    got = df.select(T.caption_artifacts(F.col("c")).alias("a"), T.figure_number(F.col("c")).alias("n"), T.plate_number(F.col("c")).alias("p")).collect()
    assert [list(r["a"]) for r in got] == [["T5:21"], [], ["Qxc4", "K2:7"], []]
    assert [r["n"] for r in got] == ["图8-3", "图", "图一三〇", "图"]
    assert got[1]["p"] == "图版十九"


XML = """<book xmlns="http://docbook.org/ns/docbook"><section><para>T3:14，磨光石质。</para><figure><mediaobject><imageobject><imagedata fileref="m/a.png" contentwidth="5" contentdepth="5"/></imageobject></mediaobject><caption role="figure-title"><para>图四 石器</para></caption></figure><para role="figure-note">1. 石刀（T3:14） 2. 石凿（T3:20）</para>
<figure><mediaobject><imageobject><imagedata fileref="m/b.png"/></imageobject></mediaobject><caption role="figure-title"><para>图五 骨针（H8：2）</para></caption></figure><para>H8：2，通体磨制。</para>
<figure><mediaobject><imageobject><imagedata fileref="m/c.png"/></imageobject></mediaobject><caption><para>别的题</para></caption></figure></section></book>"""


@pytest.fixture(scope="module")
def elements(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("shelf") / "books"
    for b in ("one", "two"):
        (d / b / "x").mkdir(parents=True)
        (d / b / "x" / "data.xml").write_text(XML, "utf-8")
    (d / "none").mkdir()
    assert [r["book"] for r in docbook.books(spark, str(d)).collect()] == ["one", "two"]
    return docbook.elements(docbook.report_files(spark, str(d))).cache()


def test_run_single(spark, elements):
    run = reports.run_single(elements)
    pairs = sorted((r["book"], r["artifact_id"], r["image_path"], r["description_text"]) for r in run.pairs.collect())
    assert pairs == [(b, "H8:2", "图五_01_H8-2.png", "H8：2，通体磨制。") for b in ("one", "two")]
    assert {(r["figure_id"], r["reason"]) for r in run.violations.collect()} == {(f"{b}:c", "caption_missing") for b in ("one", "two")}
    assert {r["status"] for r in run.figures.where("image_type = 'multi_line_artifact'").collect()} == {"SKIPPED_OFFLINE"}


def test_run_book(spark, elements):
    run = reports.run_book(elements)
    pairs = sorted((r["artifact_id"], r["image_path"], r["description_text"]) for r in run.pairs.where("book = 'one'").collect())
    assert pairs == [("H8:2", "图五_01_H8-2.png", "H8：2，通体磨制。"), ("T3:14", "图四_1_T3-14.png", "T3:14，磨光石质。"), ("T3:20", "图四_2_T3-20.png", None)]
    status = {r["figure_id"]: r["status"] for r in run.figures.collect()}
    assert status["one:a"] == "OUTPUT" and status["one:b"] == "OUTPUT" and status["one:c"] == "EXCLUDED"
    assert [r["pairs"] for r in reports.totals(run).orderBy("total", "book").collect()] == [3, 3, 6]


class Improving(P.MockModels):
    """Defects left in each round, by book: one has fewer each time, two as many."""

    def __init__(self, ground):
        super().__init__(ground)
        self.prompts = []

    def diagnose(self, figs):
        n = F.when(F.col("book") == "one", 2 - F.col("iteration")).otherwise(2)
        return figs.select("figure_id", F.array_repeat(F.lit("under_seg"), n).alias("defects"), F.array(F.lit("1,1")).alias("points"))

    def segment(self, figs, prompted=False):
        if prompted:
            self.prompts += [r["figure_id"] for r in figs.collect()]
        return super().segment(figs, prompted)


def test_supervised_run(spark, elements):
    ground = spark.createDataFrame([(f"{b}:a", ["1", "2"]) for b in ("one", "two")], "figure_id string, seqs array<string>")
    models = Improving(ground)
    status = {r["figure_id"]: r["status"] for r in reports.run_book(elements, models).figures.collect()}
    assert (status["one:a"], status["two:a"]) == ("OUTPUT", "PENDING_REVIEW")
    assert sorted(set(models.prompts)) == ["one:a", "two:a"]


def test_alarms(spark):
    items = "array<struct<seq:string,seq_list:array<int>,name:string,artifact_ids:array<string>>>"
    rows = [("n", [("1", [1], "a", ["M:1"])], ["1", "2"], [], []), ("n", [("1", [1], "a", []), ("2", [2], "b", [])], ["1"], [(None,), ("1",)], [(True,)]), ("n", [], ["1", "2"], [("8",), ("1",)], []), (None, [], ["1"], [], [])]
    df = spark.createDataFrame(rows, f"note string, items {items}, ocr array<string>, scales array<struct<seq_ref:string>>, masks array<struct<incomplete:boolean>>")
    got = [list(r[0]) for r in df.select(U.alarms(F.col("note"), F.col("items"), F.col("ocr"), F.col("scales"), F.col("masks"))).collect()]
    assert got == [["E002"], ["E001", "E004", "E006"], ["E002", "E003", "E005"], []]


def test_error_outcomes(spark):
    rows = [("E001", "x"), ("E400", "ocr"), ("E1000", "ocr"), ("E1000", "sam"), ("E101", "x"), ("E300", "x")]
    got = [tuple(r["o"]) for r in spark.createDataFrame(rows, "c string, s string").select(C.error_outcome(F.col("c"), F.col("s")).alias("o")).collect()]
    assert got == [("PENDING_REVIEW", "E001", None, False), (None, None, None, True), (None, None, None, True), ("PENDING_REVIEW", None, "E1000", False), ("EXCLUDED", None, "E101", False), ("PENDING_REVIEW", None, "E300", False)]
    assert C.code_table(spark).count() == 22


def test_models(spark, tmp_path):
    class Coded(Exception):
        code = "E600"

    requests = spark.createDataFrame([("vlm", "diagnose", f"f{k}", 0, str(k)) for k in (0, 1, 2, 3, 4, 4)], "service string, operation string, figure_id string, iteration int, request string")
    recorded = spark.createDataFrame([("vlm:diagnose:f1:0", "old")] * 2, P.REPLAY)

    def make():
        def call(x):
            if x == "3":
                raise ValueError
            if x == "4":
                raise Coded
            return "new" + x

        return call

    log = str(tmp_path / "log")
    rows = P.call_model(requests, recorded, make, qps=1000, tasks=2, log=log).collect()
    assert len(rows) == 6 and {r["response"] for r in spark.read.parquet(log).collect()} == {"new0", "new2"}
    got = {r["figure_id"]: (r["response"], r["error"], r["replayed"]) for r in rows}
    assert got == {"f4": (None, "E600", False), "f0": ("new0", None, False), "f1": ("old", None, True), "f2": ("new2", None, False), "f3": (None, "E1000", False)}
    tries = []
    call = P.with_retries(lambda x: tries.append(x) or (_ for _ in ()).throw(TimeoutError()), sleep=lambda s: None)
    with pytest.raises(TimeoutError):
        call("a")
    assert len(tries) == 3
    with pytest.raises(RuntimeError):
        P.NoModels().segment


def test_store(spark, tmp_path):
    rows = [("a/b.png", bytearray(b"1")), ("../x", bytearray(b"2")), ("/abs", bytearray(b"3")), ("", bytearray(b"4"))]
    assert store.put_objects(spark.createDataFrame(rows, "key string, content binary"), str(tmp_path / "o")) == 1
    assert (tmp_path / "o/a/b.png").read_bytes() == b"1"
    pairs = spark.createDataFrame([("b", "f", "M:1", 1), ("b", "f", "M:1", 2)], "book string, figure_id string, artifact_id string, v int")
    for _ in range(2):
        store.persist(pairs, str(tmp_path / "t"), "pair_records", "v")
    assert [r["v"] for r in store.read_table(spark, str(tmp_path / "t"), "pair_records").collect()] == [2]
    assert len(store.json_schemas()) == 8 and json.loads(store.json_schemas()["pair"])["type"] == "struct"
    assert store.white_png().startswith(b"\x89PNG")


def test_config(tmp_path):
    for bad in ("a:\n  - 1\n", "a: [1]\n", "a: &x 1\n", "a: |\n  text\n", "a\n"):
        (tmp_path / "bad.yaml").write_text(bad)
        with pytest.raises(ValueError):
            config.read_yaml(tmp_path / "bad.yaml")
    (tmp_path / "q.yaml").write_text("a: 'x # y'\nb:\n  \"c\": -1.5  # z\n")
    assert config.read_yaml(tmp_path / "q.yaml") == {"a": "x # y", "b": {"c": -1.5}}
    (tmp_path / "t.yaml").write_text("mask:\n  iou_target: 0.9\nloop:\n  max_iteration: 2  # fewer\ncapability:\n  rate_limits:\n    vlm: 12\n")
    t = config.load_thresholds(tmp_path / "t.yaml")
    assert (t.mask_iou_target, t.max_iteration, t.no_improve_rounds, t.rate_limits) == (0.9, 2, 2, {"vlm": 12})
    (tmp_path / "f.yaml").write_text("s9_loop: false\nother: 1\n")
    assert config.load_flags(tmp_path / "f.yaml").s9_loop is False and config.load_flags(tmp_path / "no").s9_loop is True


def test_streams(spark, tmp_path):
    from sherdflow.streaming import reviews

    events = spark.createDataFrame([("e1", "f1", "accept"), ("e1", "f1", "accept"), ("e2", "f2", "drop")], "event_id string, figure_id string, decision string").withColumn("ts", F.current_timestamp())
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    reviews.run_available(reviews.tasks(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    rounds = spark.createDataFrame([("f1", 1, 3), ("f1", 2, 2), ("f1", 3, 2), ("f2", 1, 0)], "figure_id string, round long, n_defects long")
    rounds.write.parquet(str(tmp_path / "rounds"))
    stream = spark.readStream.schema(rounds.schema).parquet(str(tmp_path / "rounds"))
    reviews.run_available(reviews.supervise(stream), str(tmp_path / "out2"), str(tmp_path / "cp2"))
    got = {(r["figure_id"], r["round"]): (r["iteration"], r["no_improve"], r["next"]) for r in spark.read.parquet(str(tmp_path / "out2")).collect()}
    assert got == {("f1", 1): (1, False, "retry"), ("f1", 2): (2, False, "retry"), ("f1", 3): (2, True, "bridge_review"), ("f2", 1): (0, False, "bridge_review")}


def test_select_paragraphs(spark):
    from sherdflow.operators import figures as G

    figs = [("b", "f1", ["M1:1", "M4：12"], "图一"), ("b", "f2", [], "图2O"), ("b", "f3", None, "图三"), ("b", "f4", [], ""), ("c", "f5", ["M1:1"], "图一"), ("b", "f6", ["H3①:2", ""], "图一"), ("c", "f7", ["一个很长的编号M1:1"], "x")]
    texts = ["M1：1，豆。见图一", "M1:12，壶", "见图 2〇", "图三与图2o", "无号", "", "H3①:2与M4:123，aM1:1，bM1:1", "另有三件", None]
    paras = [(b, k, f"p{k}", t) for b in ("b", "c", "d") for k, t in enumerate(texts)]
    f = spark.createDataFrame(figs, "book string, figure_id string, artifacts array<string>, fig_number string")
    p = spark.createDataFrame(paras, "book string, para_idx int, id string, text string")
    got = sorted((r["figure_id"], r["para_idx"]) for r in G.select_paragraphs(f, p).collect())
    norm = lambda t: t.replace("：", ":").replace("①", "1")
    canon = lambda t: t.replace("O", "〇").replace("o", "〇").replace(" ", "")
    want = []
    for book, fig, arts, number in figs:
        for b, k, _, t in paras:
            if b == book and t is not None and (any(norm(a) in norm(t) for a in arts) if arts else canon(number) != "" and canon(number) in canon(t)):
                want.append((fig, k))
    assert got == sorted(want) and ("f2", 2) in want and ("f2", 3) in want


def test_reports_of_runs(spark, elements, tmp_path, capsys):
    """Command line, tables, resume, images, broken reports, totals of books without figures."""
    from sherdflow import __main__ as cli
    from sherdflow.sources import images

    top = tmp_path / "b+oks"
    for b, xml in (("one", XML), ("bad", "<book><para>"), ("none", "<book><section><para>x</para></section></book>")):
        (top / b / "m").mkdir(parents=True)
        (top / b / "data.xml").write_text(xml, "utf-8")
    (top / "one" / "m" / "b.png").write_bytes(store.white_png(4))
    cli.main(["run-books", "--books-dir", str(top), "--persist", str(tmp_path / "t")], spark)
    told = json.loads(capsys.readouterr().out)
    assert told["books"] == 3 and set(told["results"]) == {"one", "bad", "none"}
    assert told["results"]["bad"]["violations"] == 1 and told["results"]["none"]["figures"] == 0
    assert told["results"]["one"] == {"figures": 3, "pairs": 3, "violations": 1, "statuses": {"EXCLUDED": "1", "OUTPUT": "2"}}
    assert store.read_table(spark, str(tmp_path / "t"), "figure_states").count() == 3 and store.read_table(spark, str(tmp_path / "t"), "diagnostics").count() == 1
    cli.main(["run-book", "--book", "one", "--books-dir", str(top), "--persist", str(tmp_path / "t"), "--resume"], spark)
    assert json.loads(capsys.readouterr().out)["total"]["figures"] == 0
    cli.main(["run-single", "--book", "one", "--books-dir", str(top), "--write-images", str(tmp_path / "o")], spark)
    out = capsys.readouterr().out
    assert "one:b | H8:2 | " in out and (tmp_path / "o" / "图五_01_H8-2.png").read_bytes() == store.white_png(4)
    with pytest.raises(SystemExit):
        cli.main(["run-single", "--book", "no", "--books-dir", str(top)], spark)
    files = docbook.report_files(spark, str(top)).where("book = 'one'")
    figs = docbook.elements(files).where("tag = 'figure'").select("book", "fileref")
    assert [tuple(r) for r in images.families_of(figs, files, images.images(spark, str(top))).collect()] == [("one", "m/b.png", "line")]


def test_errors_of_models(spark, elements):
    errors = spark.createDataFrame([("one:a", "E600", "sam"), ("two:a", "E400", "ocr"), ("one:b", "E101", "x")], "figure_id string, code string, service string")
    run = reports.run_book(elements, errors=errors)
    got = {r["figure_id"]: (r["status"], r["exclude_reason"], r["event_id"] is not None) for r in run.figures.collect()}
    assert got["one:a"] == ("PENDING_REVIEW", "E600", True) and got["two:a"] == ("OUTPUT", None, False) and got["one:b"] == ("EXCLUDED", "E101", False)
    assert {r["figure_id"] for r in run.pairs.collect()} == {"two:a", "two:b"}
    assert run.figures.select("trace_id").distinct().count() == 6


def test_stand_ins(spark):
    figs = spark.createDataFrame([("f1",), ("f2",)], "figure_id string")
    models = P.MockModels(spark.createDataFrame([("f1", ["1"], "single_plate_artifact")], "figure_id string, seqs array<string>, image_type string"))
    assert {r["figure_id"]: r["image_type"] for r in models.classify(figs).collect()} == {"f1": "single_plate_artifact", "f2": "discarded"}
    assert models.confirm_text(figs).first()["accepted"] is True

    class Turned(P.MockModels):
        def read(self, figs):
            seqs, scales = super().read(figs)
            return seqs.withColumn("orientation", F.lit("v")), scales

    got = {r["figure_id"]: r["orientation"] for r in P.image_annotations(Turned(models.ground), figs).collect()}
    assert got == {"f1": "v", "f2": "h"}


def test_routes(spark):
    one = spark.range(1)
    v = lambda c: one.select(c.alias("v")).first()["v"]
    lit = F.lit
    assert [v(C.route_report(lit(x))) for x in ("EXCLUDED", "PARSED")] == ["end", "classify_figure"]
    assert [list(v(C.route_classified(lit(s), lit(k)))) for s, k in (("EXCLUDED", "discarded"), ("x", "single_plate_artifact"), ("x", "multi_line_artifact"), ("x", "multi_plate_artifact"))] == [["end"], ["parse_single"], ["parse_text", "parse_image"], ["end"]]
    assert [v(C.route_single(lit(x))) for x in ("EXCLUDED", "PENDING_REVIEW", "CLASSIFIED_PLATE")] == ["end", "bridge_review", "assemble"]
    assert [v(C.route_assembled(lit(s), lit(k))) for s, k in (("PENDING_REVIEW", "multi_line_artifact"), ("x", "single_line_artifact"), ("x", "multi_line_artifact"))] == ["bridge_review", "bridge_review", "supervise"]


def test_masks_and_their_regions(spark):
    masks = spark.createDataFrame([("f", "1", 1), ("f", "2", 2), ("f", "3", 3)], "figure_id string, seq string, scale_level int")
    notes = spark.createDataFrame([("f", "1.", None, 0), ("f", "x", ["2", "3"], 1)], "figure_id string, text string, group array<string>, ord int")
    scales = spark.createDataFrame([("f", "0-3厘米", "1", 0), ("f", "0-9厘米", None, 1)], "figure_id string, text string, seq_ref string, ord int")
    got = {r["seq"]: (list(r["text_regions"]), list(r["scale_regions"])) for r in U.mask_regions(masks, notes, scales).collect()}
    assert got == {"1": (["1."], ["0-3厘米"]), "2": (["x"], ["0-9厘米"]), "3": (["x"], [])}


def test_streams_of_calls_and_decisions(spark, tmp_path):
    from sherdflow.streaming import reviews

    calls = spark.createDataFrame([("vlm", f"2020-01-01 00:00:0{k // 3}.{k % 3}") for k in range(6)] + [("ocr", "2020-01-01 00:00:00")], "service string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {(r["service"], r["calls"], r["over"]) for r in reviews.calls_per_second(calls, 2).collect()}
    assert got == {("vlm", 3, 1), ("ocr", 1, 0)}
    calls.select("service").withColumn("event_id", F.lit("e")).withColumn("decision", F.when(F.col("service") == "ocr", "accept").otherwise("drop")).dropDuplicates(["service"]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("service string, event_id string, decision string").parquet(str(tmp_path / "in"))
    waiting = spark.createDataFrame([("f1", "e")], "figure_id string, event_id string")
    reviews.run_available(reviews.resume(stream, waiting), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {r["status"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"OUTPUT", "EXCLUDED"}


def test_note_parsers(spark):
    @N.register("none")
    def none(df, note, out):
        return df.withColumn(out, F.array().cast(f"array<{N.ITEM}>"))

    df = spark.createDataFrame([("1. 石斧",)], "n string")
    assert N.parse_notes(df, "n", strategy="none").first()["note_items"] == [] and len(N.parse_notes(df, "n").first()["note_items"]) == 1
    del N.NOTE_PARSERS["none"]


def test_claim_and_further_tries(spark):
    from sherdflow.operators import review as R

    figs = spark.createDataFrame([("INIT",), ("OUTPUT",)], "status string")
    assert sorted(tuple(r) for r in store.claim(figs).collect()) == [("OUTPUT", False), ("PARSED", True)]
    got = [r["p"] for r in spark.createDataFrame([(0, 1), (1, 1), (2, 2), (2, 3)], "n int, e int").select(R.action_params(F.col("n"), F.col("e")).alias("p")).collect()]
    assert [None if x is None else tuple(x) for x in got] == [None, (False, None), (True, None), (True, "high")]
