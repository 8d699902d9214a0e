"""Corpus pipeline: documents -> packed sequences, in five stages; counted as part of sherdflow.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of docs.

1. toxicity: rows with a score of 0.5 or more go. Labels outside the held-out fifth teach the lexicon.
2. near_duplicates: of documents linked by 80 % of their five-word shingles, the one with the smallest doc_id stays.
   Rows of one doc_id with different texts are different documents (the one with the least text hash comes first);
   rows without doc_id are documents by their text, last in order; of rows that agree in both, one stays (the one
   whose other columns have the least hash).
3. secrets: every secret's text is replaced by a mark of its kind; n_chars follows. No row goes.
4. mixing: each document is repeated as often as the mix takes it, 0 to 2 times, always whole.
5. packing: pieces of at most 1024 token ids, neighbours on the curve side by side.

Cases: as the operators define them. Rows with one doc_id (or none) that pass stage 2 are one document in stage 4 if
they agree in source and size. Extra columns pass through all stages but the last.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sherdflow.llm._io import beside, checkpoint, name_beside, small_batches, table, tidy
from sherdflow.llm._text import batches, give_back
from sherdflow.llm.op02_packing import Pack
from sherdflow.llm.op04_mixing import Mix, n_words
from sherdflow.llm.op05_toxicity import trained
from sherdflow.llm.op07_secrets import SecretScan
from sherdflow.llm.op10_jaccard import JaccardJoin


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    lexicon = trained(spark, docs, sf_dir)

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1000):
            keep = [lexicon.score(*lexicon.features(t)) < 0.5 for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))
        give_back()

    at = docs.columns.index("text")
    return docs.mapInArrow(rows, docs.schema)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that numbers the documents: the doc_id, or for further texts of one a number above all ids."""
    node, text = name_beside(docs, "node"), F.xxhash64("text")
    again = checkpoint(docs.groupBy("doc_id").agg(F.count("*").alias("k")).where("doc_id is null or k > 1"))
    if not again.limit(1).count():
        return docs.withColumn(node, F.col("doc_id").cast("long")), node
    # of rows that agree in id and text one stays
    several = docs.join(beside(again.select(F.col("doc_id").alias(node))), docs["doc_id"].eqNullSafe(F.col(node)), "left_semi")
    single = docs.join(beside(again.select(F.col("doc_id").alias(node))), docs["doc_id"].eqNullSafe(F.col(node)), "left_anti")
    row = F.struct(*(F.col(c) for c in docs.columns))
    kept = several.groupBy("doc_id", text.alias("hash")).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row"))
    least = kept.groupBy("doc_id").agg(F.min("hash").alias("least")).withColumnRenamed("doc_id", node)
    kept = kept.join(least, kept["doc_id"].eqNullSafe(least[node])).select("row", "hash", (F.col("row.doc_id").isNotNull() & (F.col("hash") == F.col("least"))).alias("own"))
    kept = checkpoint(kept.orderBy(F.col("row.doc_id").asc_nulls_last(), "hash"))  # so that their numbers are in this order
    above = (docs.agg(F.max("doc_id")).first()[0] or 0) + 1
    number = F.when(F.col("own"), F.col("row.doc_id").cast("long")).otherwise(F.lit(above) + F.monotonically_increasing_id())
    return single.withColumn(node, F.col("doc_id").cast("long")).unionByName(kept.select("row.*", number.alias(node))), node


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows, node = _numbered(docs)
    of = JaccardJoin(shingle=5, percent=80)(rows, node, "text")
    gone = checkpoint(of.where("doc != component_id").select(F.col("doc").alias(node)))
    del of
    tidy(spark)  # the join's steps end here
    return rows.join(beside(gone), node, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scan = SecretScan.fit(docs, "text")
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1000):
            old = b.column(at).to_pylist()
            new = [scan.redacted(t) for t in old]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if size is not None:
                kept = b.column(size).to_pylist()
                cols[size] = pa.array([n if x == y else len(y) for n, x, y in zip(kept, old, new)], b.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
        give_back()

    return docs.mapInArrow(rows, docs.schema)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    mixed = Mix(packet=None)(docs, "doc_id", "source", n_words(F.col("text")))
    id_, times = name_beside(docs, "mixed_id"), name_beside(docs, "times")
    taken = checkpoint(mixed.where("taken > 0").groupBy(F.col("key").alias(id_)).agg(F.max(F.expr("taken div size")).cast("int").alias(times)))
    full = docs.join(beside(taken), docs["doc_id"].eqNullSafe(F.col(id_)))
    return full.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select([docs[c] for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return Pack(keep_ids=False)(docs, "doc_id", "text").withColumnRenamed("doc", "doc_id")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: The stages learn, decode and tokenise: SQL can't express them. tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    checkpoint(spark.range(1))  # sets the folder where it is unset
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{base}/pipeline-{os.urandom(6).hex()}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
