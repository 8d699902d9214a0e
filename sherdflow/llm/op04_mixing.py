"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, followed by the same queue again for each further
pass. A packet's virtual finish time is the source's tokens up to its end, divided by the source's target. All
packets are sorted by finish time over the whole corpus and served until the total budget is spent; so every source
gets its share at any cut, and repeats begin only once a source's documents are used up. Documents longer than
`packet` words are several packets, so a source misses its target by less than one packet. With packet=None a
document is one packet and is taken whole or not at all in each pass.

Only DataFrame functions are used. Running sums are built level by level, so neither a hot source nor the total order
is summed in one task: inside (source, slot) groups, slots being ranges of the shuffle hash, and inside equal steps of
virtual time, each of a few hundred rows; then over blocks of BLOCK slots or steps, over blocks of blocks, and so on.
The sources' table (one row each) is ranked in one task; it has a few numbers for each source.

Cases: null text has size 0; documents of size 0 are never taken (taken 0); null source is a source, last in order;
no words at all: target 0.0 everywhere; equal shuffle keys (repeated rows) are ordered by size and are
interchangeable beyond that; a null doc_id is a key like any other; empty table: empty result; extra columns pass
through, unless they bear a name that the operator adds, which it then replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._io import checkpoint, table

WEIGHTS = (3.0, 1.0, 2.0)


#: places that one window sums
BLOCK = 128


def starts(sums: DataFrame, at: str, value: str, places: int, *of: str) -> DataFrame:
    """sums (of, at: a whole number below `places`, value) with `start`: the sum of value over all smaller places, for
    each `of`. Beyond BLOCK places a window sums inside a block, and blocks are summed likewise."""
    before = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    if places <= BLOCK:
        return sums.withColumn("start", F.coalesce(F.sum(value).over(before(*of).orderBy(at)), F.lit(0)))
    over = f"{at}_block"  # a name for each level
    sums = sums.withColumn(over, F.floor(F.col(at) / BLOCK))
    blocks = sums.groupBy(*of, over).agg(F.sum(value).alias("inside"))
    blocks = starts(blocks, over, "inside", -(-places // BLOCK), *of).withColumnRenamed("start", "sooner").drop("inside")
    sums = sums.withColumn("nearer", F.coalesce(F.sum(value).over(before(*of, over).orderBy(at)), F.lit(0)))
    a, b = sums.alias("a"), blocks.alias("b")
    on = F.col(f"a.{over}") == F.col(f"b.{over}")
    for c in of:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, on).select("a.*", (F.col("a.nearer") + F.col("b.sooner")).alias("start")).drop(over, "nearer")


def n_words(text: Column) -> Column:
    r"""Number of [^\x20\x09-\x0D]+ in a text (null: 0)."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


@dataclass
class Mix:
    weights: tuple = WEIGHTS
    budget: float = 1.5
    passes: int = 2
    packet: int | None = 256
    seed: str = "mix"
    #: documents in a slot of the running sum over a source, packets in a step of virtual time
    slot_rows: int = 500

    def targets(self, sizes: DataFrame) -> DataFrame:
        """source, source_size, target: shares by weight, none above passes * source_size, the excess reshared.

        Resharing until none is above ends where target = min(cap, level * weight) for one level; in the order of
        cap / weight the capped sources come first, so the level follows from running sums.
        """
        per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
        cycle = F.array(*[F.lit(float(w)) for w in self.weights])
        per = per.withColumn("weight", F.get(cycle, (rank % len(self.weights)).cast("int"))).withColumn("cap", F.col("source_size") * F.lit(float(self.passes)))
        by = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
        every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        per = (
            per.withColumn("asked", F.sum("source_size").over(every) * F.lit(float(self.budget)))
            .withColumn("capped", F.sum("cap").over(by.rowsBetween(W.unboundedPreceding, -1)))
            .withColumn("open_weight", F.sum("weight").over(by.rowsBetween(0, W.unboundedFollowing)))
            .withColumn("level", (F.col("asked") - F.coalesce("capped", F.lit(0.0))) / F.col("open_weight"))
            # the level is that of the first source that it doesn't fill
            .withColumn("place", F.row_number().over(by))
            .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
            .withColumn("final", F.min_by("level", F.when(F.col("fits"), F.col("place"))).over(every))
        )
        target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight")))
        return per.select("source", "source_size", target.alias("target"))

    def __call__(self, df: DataFrame, key: str, source: str, size: Column) -> DataFrame:
        """key, source, size, source_size, target, taken of every row."""
        spark = df.sparkSession
        rows = checkpoint(df.select(df[key].alias("key"), df[source].alias("source"), size.cast("long").alias("size")))
        n = rows.count()
        slots = max(1, -(-n // self.slot_rows))
        order = F.md5(F.concat_ws("|", F.lit(self.seed), F.coalesce(F.col("key").cast("string"), F.lit(""))))
        slot = F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * slots).cast("int")
        rows = rows.withColumn("order", order).withColumn("slot", slot)

        # running tokens of each source: inside slots, then over slots
        share = self.targets(rows)
        slots_of = starts(rows.groupBy("source", "slot").agg(F.sum("size").alias("slot_size")), "slot", "slot_size", slots, "source").withColumnRenamed("start", "slot_start")
        same = lambda a, b: a.eqNullSafe(b)
        slots_of = slots_of.alias("a").join(share.alias("b"), same(F.col("a.source"), F.col("b.source"))).select("a.source", "a.slot", "a.slot_start", "b.source_size", "b.target")
        inside = W.partitionBy("source", "slot").orderBy("order", "key", "size").rowsBetween(W.unboundedPreceding, -1)
        rows = rows.withColumn("in_slot", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        rows = rows.alias("a").join(slots_of.alias("b"), same(F.col("a.source"), F.col("b.source")) & (F.col("a.slot") == F.col("b.slot")))
        rows = checkpoint(rows.select("a.key", "a.source", "a.size", "a.order", "b.source_size", "b.target", (F.col("a.in_slot") + F.col("b.slot_start")).alias("start")))

        # packets with virtual finish times
        total = rows.select(F.sum("size")).first()[0] or 0
        budget = int(total * self.budget)
        packet = F.greatest(F.col("size"), F.lit(1)) if self.packet is None else F.lit(self.packet).cast("long")
        work = (
            rows.where("size > 0 and target > 0")
            .withColumn("row", F.struct("source", "start"))
            .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(self.passes - 1))))
            .withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, packet)))
            .withColumn("words", F.least(packet, F.col("size") - F.col("from")))
            .withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("start") + F.col("from") + F.col("words")) / F.col("target"))
        )
        # served in order of finish: sums of steps of virtual time, then inside a step
        packets = self.passes * (n + (total // self.packet if self.packet else 0))
        steps = max(1, -(-packets // self.slot_rows))
        work = work.withColumn("step", F.floor(F.col("finish") * steps))
        places = (work.agg(F.max("step")).first()[0] or 0) + 1
        steps_of = starts(work.groupBy("step").agg(F.sum("words").alias("step_words")), "step", "step_words", places).withColumnRenamed("start", "step_start").where(F.col("step_start") < budget)
        inside = W.partitionBy("step").orderBy("finish", F.col("source").asc_nulls_last(), "start", "from").rowsBetween(W.unboundedPreceding, -1)
        left = F.lit(budget) - F.col("step_start") - F.coalesce(F.sum("words").over(inside), F.lit(0))
        whole = F.when(left >= F.col("words"), F.col("words")).otherwise(0) if self.packet is None else F.least("words", left)
        served = work.join(steps_of, "step").withColumn("got", whole).where("got > 0")
        taken = served.groupBy("source", "start", "size", "key").agg(F.sum("got").alias("taken"))

        a, b = rows.alias("a"), taken.alias("b")
        on = same(F.col("a.source"), F.col("b.source")) & same(F.col("a.key"), F.col("b.key")) & (F.col("a.start") == F.col("b.start")) & (F.col("a.size") == F.col("b.size"))
        return a.join(b, on, "left").select("a.key", "a.source", "a.size", "a.source_size", "a.target", F.coalesce("b.taken", F.lit(0)).cast("long").alias("taken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to 150 % of all words."""
    out = Mix()(table(spark, sf_dir, "documents"), "doc_id", "source", n_words(F.col("text")))
    return out.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
h AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM l),
f AS (SELECT *, (SELECT level FROM h WHERE level * weight <= cap ORDER BY place LIMIT 1) AS final FROM h),
t AS (SELECT source, source_size, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * weight) END AS target FROM f),
r AS (SELECT d.*, t.source_size, t.target, CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT r.*, pass, frm, least(256, size - frm) AS words, (pass * source_size + start + frm + least(256, size - frm)) / target AS finish
      FROM r, (SELECT unnest([0, 1]) AS pass) AS q, LATERAL (SELECT unnest(range(0, size, 256)) AS frm) AS u WHERE size > 0 AND target > 0),
g AS (SELECT *, CAST(floor((SELECT sum(size) FROM d) * 1.5::DOUBLE) AS BIGINT)
                - coalesce(sum(words) OVER (ORDER BY finish, source NULLS LAST, start, frm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM p),
k AS (SELECT doc_id, source, start, size, CAST(sum(least(words, room)) AS BIGINT) AS taken FROM g WHERE room > 0 GROUP BY ALL)
SELECT r.doc_id, r.size, r.source_size, r.target, coalesce(k.taken, 0) AS taken
FROM r LEFT JOIN k ON r.doc_id IS NOT DISTINCT FROM k.doc_id AND r.source IS NOT DISTINCT FROM k.source AND r.start = k.start AND r.size = k.size
"""
