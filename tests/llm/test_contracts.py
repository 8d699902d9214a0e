"""The registered queries on the smallest tables: columns, and every fixed column against plain Python."""

import hashlib
import os
import re
import zlib

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = {
    "op1_urls": "page_id host path rule verdict",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_substrings": "doc_id n_words n_removed kept_sha256",
    "op4_mixing": "doc_id size source_size target taken",
    "op5_toxicity": "doc_id held_out score predicted",
    "op6_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8_audio_features": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op9_html": "page_id url text n_chars",
    "op10_jaccard": "doc_id n_shingles component_id",
}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_of(spark, name):
    from sherdflow.llm.queries import QUERIES

    df = QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    return df.collect()


def test_tokens(spark, docs):
    import numpy as np
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {k: np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for k, x in docs.items()}
    rows = rows_of(spark, "op2_packing")
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) and 0 < r["length"]
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))


def test_toxicity(spark, docs):
    rows = rows_of(spark, "op5_toxicity")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_counts(spark, docs):
    for r in rows_of(spark, "op6_quality"):
        t = docs[r["doc_id"]] or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 20 or 100 * r["n_repeat_words"] > 30 * len(w)) and not (r["base_failed"] and r["kept"])


def test_secrets(spark, docs):
    from sherdflow.llm.op07_secrets import KINDS, base_spans  # held against a plain scanner elsewhere

    for r in rows_of(spark, "op7_secrets"):
        base = base_spans(docs[r["doc_id"]] or "")
        told = [f"{KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert [x for x in r["spans"].split(",") if x and not x.startswith("markov")] == told


def test_media(spark, docs):
    for r in rows_of(spark, "op8_audio_features"):
        raw = (docs[r["doc_id"]] or "").encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r["media_bytes"] > len(payload) and r["tensor_bytes"] > 0 and r["feature"]


def test_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = rows_of(spark, "op9_html")
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    assert all(r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"]) and "  " not in r["text"] for r in rows)
    urls = rows_of(spark, "op1_urls")
    assert sorted(r["page_id"] for r in urls) == sorted(pages) and {r["verdict"] for r in urls} <= {"allow", "block"}


@pytest.mark.parametrize("name", ["op3_substrings", "op4_mixing", "op10_jaccard"])
def test_sql(spark, name):
    import duckdb

    from sherdflow.llm.queries import SQL

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    cols = COLUMNS[name].split()
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    want = sorted(tuple(map(plain, x)) for x in c.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall())
    assert sorted(tuple(plain(r[x]) for x in cols) for r in rows_of(spark, name)) == want
