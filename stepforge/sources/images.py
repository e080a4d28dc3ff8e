"""Screenshot files: listing, bytes and decoded pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge import domains as D


def clean_path(c: Column) -> Column:
    """Paths comparable across sources: no scheme, forward slashes only."""
    slashes = F.replace(c, F.lit("\\"), F.lit("/"))
    return F.regexp_replace(slashes, r"^file:/+", "/")


def read_files(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """path, length, content of every file; Spark skips the bytes when unused."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(clean_path(F.col("path")).alias("path"), "length", "content")
    )


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images; files that cannot be decoded are left out."""
    return (
        spark.read.format("image")
        .option("dropInvalid", "true")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            clean_path(F.col("image.origin")).alias("path"),
            F.col("image.height").alias("height"),
            F.col("image.width").alias("width"),
            F.col("image.nChannels").alias("channels"),
            F.col("image.data").alias("data"),
        )
    )


def file_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def inline_image(length: Column, content: Column, limit_kb: int = D.INLINE_IMAGE_KB) -> Column:
    """Base64 of files below the size limit, NULL above it."""
    # base64() breaks lines after 76 characters, the attachment is one line
    return F.when(length < limit_kb * 1024, F.regexp_replace(F.base64(content), r"\s", ""))


def image_facts(files: DataFrame, pixels: DataFrame | None) -> DataFrame:
    """One narrow row per file: size, digest, and from the pixels dimensions,
    variance and perceptual hash.  Only these go through later shuffles; the bytes
    stay in the scan that read them.
    """
    from stepforge.functions import pixels as X

    facts = files.select(
        "path", "length", file_digest(F.col("content")).alias("sha256")
    )
    if pixels is None:
        return facts
    args = ("height", "width", "channels", "data")
    decoded = pixels.select(
        "path", "height", "width",
        X.pixel_variance(*args).alias("variance"),
        X.perceptual_hash(*args).alias("phash"),
    )
    return facts.join(decoded, "path", "left")


def with_screenshot(samples: DataFrame, facts: DataFrame, path_column: str = "screenshot_path") -> DataFrame:
    """Left join on the normalised path; ``file_exists`` tells whether it matched.

    Samples without a path match nothing; they are spread by their other columns, so
    that they do not meet in one task.
    """
    listing = facts.withColumnRenamed("path", "file_path").withColumn("file_exists", F.lit(True))
    path = clean_path(F.col(path_column))
    nowhere = F.concat(F.lit("\u0000"), F.xxhash64(*[c for c, kind in samples.dtypes if "map<" not in kind and kind != "variant"]).cast("string"))
    keyed = samples.withColumn("_path", F.when(F.coalesce(path, F.lit("")) == "", nowhere).otherwise(path))
    joined = keyed.join(listing, F.col("_path") == F.col("file_path"), "left")
    return joined.withColumn("file_exists", F.coalesce("file_exists", F.lit(False))).drop("file_path", "_path")
