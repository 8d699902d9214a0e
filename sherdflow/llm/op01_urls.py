"""URL filters: host rules, and a ratio of character language models.

A url is judged by the longest rule that fits; all others by two smoothed variable-order Markov models of characters,
one of accepted and one of rejected urls. Probabilities of a symbol after 3, 2, 1 and 0 symbols are blended by
Witten-Bell weights (a context counts as much as it was seen, less by how many different symbols followed it). The
score is the log-likelihood difference divided by the number of symbols; the threshold is calibrated on all labelled
urls, where the sum of both error rates is least.

Labelled urls: every different url of each host that no rule blocks is an accepted one (a blocked country or section
says nothing of characters). A host counts once: its n urls weigh 1/n each (in whole millionths), so one with a third
of all urls doesn't make its name a usual one. With every=False only the least url of each host is labelled. Each url
also gives VERSIONS rejected ones of its weight: itself with a name of a documented table of rejected names (NAMES, made by a rule)
in the place of its own host's name; so both models see the same frames of scheme, domain and path, and what tells
them apart is names. Rejected hosts that stand in the input are not labelled: they are found by their likeness to the
table's names.

Hosts are dealt into two folds by hash, names by place. A url is scored by the models that the other fold's labelled
urls have taught, so none is judged by what its own host taught, and the threshold is calibrated on unseen urls. All
hosts count, whatever the input's size. Urls are read in an alphabet of 32 symbols (letters, one for digits, the
common signs), so there are at most 2**20 grams of four for each fold: the models' table has that size bound and is
broadcast. Logarithms are kept as whole millionths, so that sums don't depend on their order.

Only DataFrame functions are used.

Cases: null url or one without "://": host and path empty, no rule; such a url is scored as the text it has (null: as
empty) and an empty text scores 0; no hosts to learn from in one of the folds: everything else is allowed; long urls are scored whole; ties
and repeated rows: each row alone, equal urls get equal verdicts; empty table: empty result; extra columns: only the
two named ones are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._io import beside, checkpoint, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ABOUT = "(?s)^.*?://([^/?#]*)([^?#]*).*$"

#: (host and path, verdict)
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Names of rejected hosts: every stem in every form.
STEMS = ("casino", "poker", "bets", "slots", "lottery", "pills", "viagra", "pharma", "payday", "loans", "porn", "adult", "escort", "spam", "ads", "replica")
FORMS = ("{}", "free-{}", "best-{}", "cheap-{}", "top-{}", "{}-online", "{}-club", "{}-now", "{}24")
NAMES = tuple(form.format(stem) for stem in STEMS for form in FORMS)
VERSIONS = 8
#: a host's weight, where its urls share it
UNIT = 1_000_000
FOLDS = 2
#: what stands before a host's name, the name, the rest
NAMED = r"(?s)^(.*?://(?:(?:www|m|blog)\.)?)([^./?#]+)(.*)$"

#: Symbols 1-31; 0 stands before the first one.
ALPHABET = LOWER + "0./-"
GRAM = 4
FOLD = 32**GRAM  # a gram's code is below; a fold's codes begin at a multiple of it


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or # or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, ABOUT, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ABOUT, 2), F.lit(""))


def symbols(text: Column) -> Column:
    """Text in the alphabet: A-Z as a-z, digits as 0, everything else as one more symbol (~)."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER + "123456789", LOWER + "0" * 9)
    return F.regexp_replace(low, r"(?s)[^a-z0./\-]", "~")


@dataclass
class UrlFilter:
    rules: tuple = RULES
    names: tuple = NAMES
    seed: str = "calibrate"
    every: bool = False  # whether all urls of a host are labelled, or its least one

    @property
    def unit(self) -> int:
        return UNIT if self.every else 1

    def rule_of(self, host: Column, path: Column) -> Column:
        """The longest rule that fits: its host is the url's or one above it, its path begins the url's."""
        out = F.lit(None).cast("string")
        for rule, _ in sorted(self.rules, key=lambda r: (len(r[0]), r[0])):
            name, _, rest = rule.partition("/")
            fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
            out = F.when(fits, rule).otherwise(out)
        return out

    def parsed(self, df: DataFrame, key: str, url: str) -> DataFrame:
        rows = df.select(df[key].alias("key"), df[url].cast("string").alias("url"))
        rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
        rows = rows.withColumn("rule", self.rule_of(F.col("host"), F.col("path")))
        ruled = F.lit(None).cast("string")
        for rule, verdict in self.rules:
            ruled = F.when(F.col("rule") == rule, verdict).otherwise(ruled)
        return rows.withColumn("ruled", ruled).withColumn("symbols", symbols(F.col("url"))).withColumn("fold", self.digits(1, 2) % FOLDS)

    def digits(self, at: int, n: int) -> Column:
        """A number from n hexadecimal digits of the host's hash."""
        return F.conv(F.substring(F.md5(F.concat(F.lit(self.seed), "host")), at, n), 16, 10).cast("int")

    def samples(self, rows: DataFrame) -> DataFrame:
        """symbols, label (0 accepted, 1 rejected), fold, w (weight, in parts of unit)."""
        hosts = rows.where("host != '' and coalesce(ruled, 'allow') = 'allow'")
        if self.every:
            hosts = hosts.select("host", "fold", "url", F.xxhash64("host").alias("of")).distinct()
            n = checkpoint(hosts.groupBy("of").agg(F.count("*").alias("n")))
            share = F.greatest(F.lit(1), F.floor(F.lit(self.unit) / F.col("n")))
            hosts = hosts.join(beside(n), "of").withColumn("w", share.cast("long"))
        else:
            hosts = hosts.groupBy("host", "fold").agg(F.min("url").alias("url")).withColumn("w", F.lit(self.unit).cast("long"))
        names = F.array(*(F.array(*map(F.lit, self.names[f::FOLDS])) for f in range(FOLDS)))[F.col("fold")]
        start = self.digits(3, 6) + (F.crc32(F.col("url").cast("binary")) if self.every else 0)  # a host's urls take turns through the names
        pick = F.transform(F.sequence(F.lit(0), F.lit(VERSIONS - 1)), lambda v: F.get(names, ((start + 7 * v) % F.size(names)).cast("int")))
        rejected = F.when(F.col("url").rlike(NAMED), F.transform(pick, lambda x: F.concat(F.regexp_extract("url", NAMED, 1), x, F.regexp_extract("url", NAMED, 3))))
        urls = F.concat(F.array("url"), F.coalesce(rejected, F.array().cast("array<string>")))
        out = hosts.select("fold", "w", F.posexplode(urls).alias("at", "url"))
        out = out.select(symbols(F.col("url")).alias("symbols"), F.least("at", F.lit(1)).alias("label"), "fold", "w")
        return out.groupBy("symbols", "label", "fold").agg(F.sum("w").alias("w"))

    @staticmethod
    def grams(rows: DataFrame, *keep: str) -> DataFrame:
        """A row for each symbol: code of it and the three before it, in base 32, in the row's fold."""
        at = F.explode(F.sequence(F.lit(1), F.char_length("symbols")))
        rows = rows.where("symbols != ''").select(*keep, "fold", F.concat(F.lit("^" * (GRAM - 1)), "symbols").alias("s"), at.alias("at"))
        code = F.col("fold")
        for k in range(GRAM):
            place = F.expr(f"CASE substring(s, at + {k}, 1) WHEN '^' THEN 0 WHEN '~' THEN 31 ELSE locate(substring(s, at + {k}, 1), '{ALPHABET}') END")
            code = code * 32 + place
        return rows.select(*keep, code.cast("int").alias("code"))

    def model(self, rows: DataFrame, samples: DataFrame) -> DataFrame:
        """code, millionths: of every gram of four that occurs, the log-likelihood ratio, rejected over accepted."""
        # all urls and samples give the grams that a score is needed for; the other folds' samples give the counts
        needed = rows.select("symbols", "fold").unionByName(samples.select("symbols", "fold")).select("*", F.lit(-1).alias("use"), F.lit(0).cast("long").alias("w"))
        others = F.filter(F.sequence(F.lit(0), F.lit(FOLDS - 1)), lambda f: f != F.col("fold"))
        taught = samples.select("symbols", F.explode(others).alias("fold"), F.col("label").alias("use"), "w")
        pre = needed.unionByName(taught).groupBy("symbols", "fold", "use").agg(F.sum("w").alias("w"))
        got = self.grams(pre, "use", "w").groupBy("code").agg(*(F.sum(F.when(F.col("use") == k, F.col("w")).otherwise(0)).alias(f"n{k}") for k in (0, 1)))
        got = checkpoint(got)
        out = got.select("code")
        part = lambda code, span: code - code % FOLD + code % span
        for k in (0, 1):
            level = got.select("code", F.col(f"n{k}").alias("n"))
            p = None  # table of (suffix of the gram, probability), from order 0 upwards
            for order in range(GRAM):
                span = 32 ** (order + 1)
                seen = level.groupBy(part(F.col("code"), span).alias("gram")).agg(F.sum("n").alias("n"))
                # the context of a gram: without its last symbol
                context = W.partitionBy((F.col("gram") / 32).cast("int"))
                seen = seen.withColumn("total", F.sum("n").over(context)).withColumn("kinds", F.sum((F.col("n") > 0).cast("long")).over(context))
                if p is None:
                    lower = F.lit(1.0 / 32)
                else:
                    seen = seen.withColumn("shorter", part(F.col("gram"), span // 32)).join(p.withColumnRenamed("gram", "shorter").withColumnRenamed("p", "low"), "shorter")
                    lower = F.col("low")
                seen_n, seen_total = F.col("n") / self.unit, F.col("total") / self.unit
                blend = F.when(F.col("total") == 0, lower).otherwise((seen_n + F.col("kinds") * lower) / (seen_total + F.col("kinds")))
                p = seen.select("gram", blend.alias("p"))
            out = out.join(p.select(F.col("gram").alias("code"), F.round(F.log("p") * 1e6).cast("long").alias(f"l{k}")), "code")
        return checkpoint(out.select("code", (F.col("l1") - F.col("l0")).alias("millionths")))

    def scored(self, rows: DataFrame, model: DataFrame, *keep: str) -> DataFrame:
        """rows with `score`, whole millionths for each symbol (0 for empty texts); equal texts are scored once."""
        text = ["symbols", "fold"]
        sums = self.grams(rows.select(text).distinct().withColumn("own", F.col("fold")), "symbols", "own").join(F.broadcast(model), "code")
        sums = sums.groupBy("symbols", F.col("own").alias("fold")).agg(F.sum("millionths").alias("sum"))
        return rows.select(*keep, *text).join(sums, text, "left").withColumn("score", F.coalesce(F.floor(F.col("sum") / F.char_length("symbols")), F.lit(0))).drop("sum", *text)

    def threshold(self, scored: DataFrame) -> int:
        """The least score that is rejected: the one of least summed error rates on labelled urls."""
        bins = scored.groupBy(F.greatest(F.lit(-4_000), F.least(F.lit(4_000), F.floor(F.col("score") / 1000))).alias("bin"))
        bins = bins.agg(*(F.sum(F.when(F.col("label") == k, F.col("w")).otherwise(0)).alias(x) for k, x in ((1, "bad"), (0, "good"))))
        below, every = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1), W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        missed = F.coalesce(F.sum("bad").over(below), F.lit(0)) / F.sum("bad").over(every)
        wronged = 1 - F.coalesce(F.sum("good").over(below), F.lit(0)) / F.sum("good").over(every)
        best = bins.withColumn("loss", F.round(missed + wronged, 9)).agg(F.min(F.struct("loss", F.abs("bin").alias("far"), "bin")).alias("x")).select("x.*").first()
        return None if best is None or best["loss"] is None else int(best["bin"]) * 1000

    def __call__(self, df: DataFrame, key: str, url: str) -> DataFrame:
        """key, host, path, rule, verdict, score of each row."""
        rows = self.parsed(df, key, url)
        samples = checkpoint(self.samples(rows))
        have = samples.select("label", "fold").distinct().count()
        plain = ["key", "host", "path", "rule"]
        if have < 2 * FOLDS:
            return rows.select(*plain, F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0).cast("long").alias("score"))
        model = self.model(rows, samples)
        cut = self.threshold(self.scored(samples, model, "label", "w"))
        out = self.scored(rows, model, *plain, "ruled")
        verdict = F.coalesce("ruled", F.when(F.lit(cut is not None) & (F.col("score") >= F.lit(cut or 0)), "block").otherwise("allow"))
        return out.select(*plain, verdict.alias("verdict"), "score")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' urls judged."""
    return UrlFilter(every=True)(table(spark, sf_dir, "pages"), "page_id", "url").withColumnRenamed("key", "page_id")
