"""Images through Spark's own image reader, and their pixels as native arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import family, family_confidence, pixel_stats

SIDE = 96


def images(spark: SparkSession, path: str) -> DataFrame:
    """origin, height, width, n_channels, data of readable images; others are dropped, not raised."""
    df = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", PATTERN).load(path)
    return df.select("image.origin", "image.height", "image.width", F.col("image.nChannels").alias("n_channels"), "image.data")


def thumbnail(data: Column, height: Column, width: Column, n_channels: Column) -> Column:
    """array<struct<r, g, b>> of at most SIDE x SIDE evenly spaced pixels (the reader keeps B, G, R order)."""
    step = F.ceil(F.greatest(height, width) / SIDE)
    byte = lambda at: F.conv(F.hex(F.substring(data, at + 1, F.lit(1))), 16, 10).cast("int")
    ys, xs = F.sequence(F.lit(0), height - 1, step.cast("int")), F.sequence(F.lit(0), width - 1, step.cast("int"))

    def pixel(y: Column, x: Column) -> Column:
        at = (y * width + x) * n_channels
        grey = n_channels == 1
        b, g, r = byte(at), byte(at + 1), byte(at + 2)
        return F.struct(F.when(grey, b).otherwise(r).alias("r"), F.when(grey, b).otherwise(g).alias("g"), b.alias("b"))

    return F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: pixel(y, x))))


def families(df: DataFrame) -> DataFrame:
    """origin, mean, pct, mid, family, confidence of images()."""
    s = df.select("origin", pixel_stats(thumbnail(F.col("data"), F.col("height"), F.col("width"), F.col("n_channels"))).alias("s")).select("origin", "s.*")
    s = s.withColumn("family", family(F.col("mean"), F.col("pct"), F.col("mid")))
    return s.withColumn("confidence", family_confidence(F.col("family"), F.col("pct"), F.col("mid")))


PATTERN = "*.{png,jpg,jpeg,gif,bmp,PNG,JPG,JPEG}"


def any_images(spark: SparkSession, path: str) -> bool:
    return not _files(spark, path).select("path").limit(1).isEmpty()


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", PATTERN).load(path)


def _places(figs: DataFrame, reports: DataFrame) -> DataFrame:
    """book, fileref, at of figures (book, fileref): a fileref is relative to its report's folder."""
    folder = reports.select("book", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"))
    at = F.regexp_replace(F.concat("folder", F.lit("/"), "fileref"), "^file:/+", "/")
    return figs.select("book", "fileref").distinct().join(folder, "book").select("book", "fileref", at.alias("at"))


def contents(spark: SparkSession, path: str, figs: DataFrame, reports: DataFrame) -> DataFrame:
    """book, fileref, content of figures' images."""
    files = _files(spark, path).select(F.regexp_replace("path", "^file:/+", "/").alias("at"), "content")
    return _places(figs, reports).join(files, "at").select("book", "fileref", "content")


def families_of(figs: DataFrame, reports: DataFrame, df: DataFrame) -> DataFrame:
    """book, fileref, family of figures (book, fileref) whose image is among images(); reports: book, path of its file."""
    told = families(df).select(F.regexp_replace("origin", "^file:/+", "/").alias("at"), "family")
    return _places(figs, reports).join(told, "at").select("book", "fileref", "family")
