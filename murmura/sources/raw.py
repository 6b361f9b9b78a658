"""Raw posts as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from murmura.functions.fields import is_bad_number, parse_timestamp
from murmura.schemas import COUNTS, RAW_TEXT

CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, path: str, on_bad: str = "raise", pattern: str | None = None) -> DataFrame:
    """All raw files of a folder or glob as one table of text columns.

    Folders inside are read too, such as those of single batches. Blank lines are skipped. A malformed line raises, or with ``on_bad="drop"`` is left out
    together with rows that have no id.
    """
    if on_bad not in ("raise", "drop"):
        raise ValueError(f"on_bad must be 'raise' or 'drop', not {on_bad!r}")
    reader = spark.read.schema(RAW_TEXT).option("mode", "FAILFAST" if on_bad == "raise" else "DROPMALFORMED")
    reader = reader.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    posts = reader.json(path)
    return posts if on_bad == "raise" else posts.filter(F.col("tweet_id") != "")


def read_raw_counted(spark: SparkSession, path: str, pattern: str | None = None) -> tuple[DataFrame, Observation]:
    """The posts of ``read_raw(on_bad="drop")``, and counts of what it passed over and what cleaning will.

    The counts are made while the rows pass, in the job that reads all of them first: ``lines``,
    ``malformed`` lines and lines ``without_id``, both skipped, and among the others ``bad_timestamp``, whose
    posts are dropped, and ``bad_replies`` and so on, numbers that are read as 0.
    """
    reader = spark.read.schema(f"{RAW_TEXT}, {CORRUPT} string").option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    malformed, has_id = F.col(CORRUPT).isNotNull(), F.coalesce(F.col("tweet_id") != "", F.lit(False))
    good = ~malformed & has_id
    counts = Observation()
    lines = reader.json(path).observe(
        counts,
        F.count("*").alias("lines"),
        F.count_if(malformed).alias("malformed"),
        F.count_if(~malformed & ~has_id).alias("without_id"),
        F.count_if(good & parse_timestamp(F.col("timestamp")).isNull()).alias("bad_timestamp"),
        *[F.count_if(good & is_bad_number(F.col(c))).alias(f"bad_{c}") for c in COUNTS],
    )
    return lines.where(good).drop(CORRUPT), counts


def append_raw(posts: DataFrame, path: str, compression: str = "none") -> None:
    """Add posts to a folder as JSON lines in UTF-8, plain or in files that readers unpack, such as ``gzip``."""
    posts.write.mode("append").json(path, compression=compression)
