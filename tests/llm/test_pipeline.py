"""The pipeline's stages against brute force, each on its own input."""

import re
from collections import Counter

import pytest

from .test_operators import BASE, PASSAGE, _corpus, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    clean = [" ".join(f"k{j}x{k}" for j in range(40)) for k in range(40)]
    rows = [(k, t, "en", f"src{k % 3}", len(t)) for k, t in enumerate(clean)]
    extra = [BASE, BASE, BASE + " end", "you idiot moron " + PASSAGE, "key: password=abcdefgh12345678 " + clean[0][:100], None, "", " "]
    rows += [(100 + k, t, "en", "src1" if k % 2 else None, len(t or "")) for k, t in enumerate(extra)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, {r[0]: r for r in rows}


def test_stages(spark, folder, tmp_path):
    import corpus_pipeline as P

    d, rows = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    state = dict(rows)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = Counter(tuple(r) for r in docs.collect())
        if name == "toxicity":
            del state[103]
        elif name == "near_duplicates":
            del state[101], state[102]
        elif name == "secrets":
            i, t, *rest = state[104]
            new = re.sub(r"password=\w+", "[assign removed]", t)
            state[104] = (i, new, *rest[:-1], len(new))
        if name != "mixing":
            assert got == Counter(state.values())
        else:
            assert set(got.values()) <= {1, 2} and set(got) <= set(state.values())
            total = sum(len(words(r[1])) for r in state.values())
            assert abs(sum(len(words(r[1])) * n for r, n in got.items()) - 1.5 * total) <= 80
    packed = P.STAGES[-1][1](spark, docs, d).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_run(spark, folder):
    import corpus_pipeline as P

    assert P.run(spark, folder[0]).count() > 0


def test_repeated_ids(spark, tmp_path):
    """Rows of one id, of none, and that agree: nothing but copies goes, and reruns agree; other columns may have any names."""
    import corpus_pipeline as P

    other = " ".join(f"other{k}" for k in range(30))
    third = " ".join(f"third{k}" for k in range(30))
    rows = [(1, BASE, "en", "a", 1, 5, "x"), (1, other, "en", "a", 1, 5, "x"), (1, other, "en", "a", 1, 5, "y"), (2, BASE, "en", "b", 1, 5, "x"), (None, third, "en", "b", 1, 5, "x"), (None, third, "en", "b", 1, 5, "x"), (None, BASE, "en", "b", 1, 5, "x"), (3, None, "en", "b", 1, 5, "x"), (3, "", "en", "b", 1, 5, "x"), (4, " ", "en", "b", 1, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long, component_id string")
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = [Counter(tuple(r) for r in P.near_duplicates(spark, d, "").collect()) for d in (docs, docs.repartition(5))]
    assert got[0] == got[1] and sum(got[0].values()) == 6
    assert {(r[0], r[1]) for r in got[0]} == {(1, BASE), (1, other), (None, third), (3, None), (3, ""), (4, " ")}
    assert P.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_driver_is_tidied(spark, folder, monkeypatch):
    """No long row of steps without the driver giving back memory, and none after the last of the join's."""
    import corpus_pipeline as P
    from sherdflow.llm import _graph, _io, op10_jaccard

    done = []
    for module in (P, op10_jaccard, _graph):
        monkeypatch.setattr(module, "checkpoint", lambda df: done.append("step") or _io.checkpoint(df))
        monkeypatch.setattr(module, "tidy", lambda s: done.append("tidy") or _io.tidy(s), raising=False)
    P.near_duplicates(spark, spark.read.parquet(f"{folder[0]}/documents.parquet"), folder[0])
    assert done[-1] == "tidy"
    assert max(len(x.split()) for x in " ".join(done).split("tidy")) <= 6


def test_secrets_threshold_from_all(spark, monkeypatch):
    """The stage's threshold lies between the highest identifier of all texts and the lowest random string."""
    import corpus_pipeline as P
    from sherdflow.llm import op07_secrets as S

    fits, fit = [], P.SecretScan.fit
    monkeypatch.setattr(P.SecretScan, "fit", lambda *a: fits.append(fit(*a)) or fits[-1])
    texts = _corpus(60, 5)
    P.secrets(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    (scan,) = fits
    names = set()
    for t in texts:
        for three in re.finditer(r"(?<![A-Za-z0-9])(?=([A-Za-z0-9]+) ([A-Za-z0-9]+) ([A-Za-z0-9]+))", t):
            w = list(three.groups())
            if 20 <= sum(map(len, w)) <= 64:
                names |= {*(j.join(w) for j in "_-/"), w[0] + "".join(x[0].upper() + x[1:] for x in w[1:])}
    highest, lowest = max(map(scan.score, names)), min(map(scan.score, S.random_strings(8000, 7)[1::2]))
    assert len(names) > 40 and highest < lowest and scan.threshold == (highest + lowest) / 2
