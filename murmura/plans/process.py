"""Raw posts to the stored clean table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.defaults import LOOKBACK_HOURS, TARGET_POSTS
from murmura.functions.fields import parse_timestamp
from murmura.operators.clean import clean_and_dedupe
from murmura.operators.lookback import fixed_lookback, reaching_window, window_start
from murmura.sources.raw import read_raw_counted
from murmura.sources.tables import write_flat, write_partitioned, write_sample
from murmura.storage import materialize


def process_posts(
    raw: DataFrame,
    as_of,
    hours: Sequence[int] = LOOKBACK_HOURS,
    target: int = TARGET_POSTS,
) -> DataFrame:
    """Clean, deduplicate, store, and select the lookback window.

    Raw posts older than the widest window go first: of each id and text the latest post stays, so an
    older one never displaces one inside a window. The whole history is cleaned only when no window
    reaches the target.
    """
    recent = raw.filter(parse_timestamp(F.col("timestamp")) >= window_start(as_of, max(hours)))
    clean = materialize(clean_and_dedupe(recent), "clean-recent")
    reached = reaching_window(clean, as_of, hours, target)
    if reached is None:
        return materialize(clean_and_dedupe(raw), "clean")
    return fixed_lookback(clean, as_of, reached)


def clean_files(spark: SparkSession, path: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored clean table of raw files read leniently, and one row with the counts of what was skipped."""
    raw, counts = read_raw_counted(spark, path, pattern)
    clean = materialize(clean_and_dedupe(raw), "clean")
    found = counts.get
    return clean, spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} bigint" for name in found))


def write_processed(posts: DataFrame, folder: str) -> str:
    """Flat table, partitioned table and sample; returns the path of the flat table."""
    flat = f"{folder}/posts"
    write_flat(posts, flat)
    stored = posts.sparkSession.read.schema(posts.schema).parquet(flat)
    write_partitioned(stored, f"{folder}/partitioned")
    write_sample(stored, f"{folder}/sample_parquet", f"{folder}/sample_csv")
    return flat
