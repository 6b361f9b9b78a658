"""Column helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.storage import materialize

#: Words are runs of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def whole(text: str | Column = "text") -> Column:
    """The text as it stands; null reads as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: str | Column = "text") -> Column:
    """All words of the whole text, in order; null and blank texts have none."""
    return F.array_remove(F.split(whole(text), GAP), "")


def n_words(text: str | Column = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table once into the shared folder and read it back: later steps don't recompute it."""
    return materialize(df, f"llm-{name}")


def set_aside(docs: DataFrame, prefix: str) -> DataFrame:
    """The same columns in the same order, but none whose name starts like an operator's own columns.

    The operator gives them their names back with ``toDF``.
    """
    free = "x"
    while any(c.lower().startswith(free) for c in docs.columns):
        free += "x"
    return docs.toDF(*[f"{free}{i}" if c.lower().startswith(prefix) else c for i, c in enumerate(docs.columns)])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def labels(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")
