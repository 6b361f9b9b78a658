"""Mixing sources to target weights, with repetition.

Sizes are summed per source with a map-side sum, targets derived from them, and each document is then
emitted ``floor(rate)`` times plus one more time if a draw seeded by its id falls under the fraction.

Cases: a null text has size 0; null is a source of its own, the last; a source without words has target
0 and none of its documents are emitted; a document without words is emitted at its source's rate and
takes nothing; rows that repeat an id share its draw; a null id draws by its text. An empty table gives
an empty mix. Further columns pass through under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.llm.common import n_words, set_aside, stored, whole

SHARE = 1.5
CAP = 2.0
WEIGHTS = (3.0, 1.0, 2.0)
SEED = "mix-1"
#: A table of targets up to this many sources is broadcast; beyond, both sides are spread over salts.
SMALL_SOURCES = 50_000
SALTS = 64


def source_targets(
    docs: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS
) -> DataFrame:
    """``mix_source``, ``source_size``, ``target`` of every source.

    Targets share ``share`` of all words by weight; a target stops at ``cap`` times its source's size
    and the excess is shared again by weight among the others, until none is above.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy(docs["source"].alias("mix_source")).agg(F.sum(n_words(docs["text"])).alias("source_size"))
    sizes = sizes.orderBy(F.asc_nulls_last("mix_source"))
    schema = T.StructType(
        [
            T.StructField("mix_source", docs.schema["source"].dataType),
            T.StructField("source_size", T.LongType()),
            T.StructField("weight", T.DoubleType()),
        ]
    )
    # The position is counted partition by partition, so even very many sources never meet in one task.
    numbered = sizes.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], float(weights[x[1] % len(weights)])))
    table = stored(spark.createDataFrame(numbered, schema).where("source_size > 0"), "sources")
    limit = F.lit(cap) * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0]
    level, budget = 0.0, share * (total or 0)
    while total:
        full = F.col("weight") * level >= limit
        held, open_weight = table.agg(
            F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))
        ).first()
        rest = (budget - held) / open_weight if open_weight else level
        if rest <= level:
            break
        level = rest
    return table.select(
        "mix_source", "source_size", F.least(limit, F.col("weight") * level).alias("target")
    )


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number from 0 to below 1 that depends on the seed and the document alone."""
    key = F.concat(F.lit(seed + "|"), F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary"))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / float(1 << 52)


def with_copies(docs: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """All documents with ``mix_size``, ``mix_target`` (of the source) and ``mix_copies``, how often the mix holds them."""
    targets = targets.select("mix_source", F.col("source_size").alias("mix_size"), F.col("target").alias("mix_target"))
    if targets.limit(SMALL_SOURCES + 1).count() <= SMALL_SOURCES:
        joined = docs.join(F.broadcast(targets), docs["source"].eqNullSafe(targets["mix_source"]), "left")
    else:  # a source may hold a third of all rows: spread it over salts
        salted = targets.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(SALTS))
        joined = docs.join(
            salted, docs["source"].eqNullSafe(salted["mix_source"]) & (salt == salted["mix_salt"]), "left"
        ).drop("mix_salt")
    rate = F.coalesce(F.col("mix_target") / F.col("mix_size"), F.lit(0.0))
    more = (draw(docs["doc_id"], whole(docs["text"]), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumns(
        {
            "mix_copies": F.floor(rate) + more,
            "mix_size": F.coalesce("mix_size", F.lit(0)),
            "mix_target": F.coalesce("mix_target", F.lit(0.0)),
        }
    ).drop("mix_source")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as it is drawn, with the columns of ``docs``."""
    named = set_aside(docs, "mix_")
    mixed = with_copies(named, source_targets(named, **options))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int")))
    return mixed.withColumn("mix_copies", copies).select(*named.columns).toDF(*docs.columns)


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: size, its source's size and target, and the words that the mix takes of it."""
    docs = docs.select("doc_id", "source", "text")
    return with_copies(docs, source_targets(docs)).select(
        "doc_id",
        n_words().alias("size"),
        F.col("mix_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (n_words() * F.col("mix_copies")).alias("taken"),
    )


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM sums),
positive AS (SELECT *, 2.0::DOUBLE * source_size AS lim FROM weighed WHERE source_size > 0),
levels AS (
  SELECT lim / w AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(lim) OVER (ORDER BY lim / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY lim / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM positive),
level AS (SELECT max(level) AS level FROM levels),
targets AS (
  SELECT source, source_size, least(lim, w * level.level) AS target FROM positive, level),
rated AS (
  SELECT s.doc_id, s.size, coalesce(t.source_size, 0)::BIGINT AS source_size, coalesce(t.target, 0)::DOUBLE AS target,
         coalesce(t.target / t.source_size, 0)::DOUBLE AS rate,
         ('0x' || substr(md5('{SEED}|' || coalesce(s.doc_id::VARCHAR, md5(coalesce(s.text, '')))), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS u
  FROM sized s LEFT JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
