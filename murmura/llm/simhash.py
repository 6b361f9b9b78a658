"""SimHash fingerprints and their near-duplicate groups.

A fingerprint is embedded as the bit counts of its 32 two-bit segments, each count written in unary
(0, 1, 2 as 00, 01, 11). The Manhattan distance of two embeddings is then the number of differing
unary bits; it never exceeds the number of differing fingerprint bits, so it is a lower bound. The 32
coordinates are cut into blocks. Points within distance 2 differ in at most two blocks, so they lie in
the same grid cell of at least one choice of all blocks but two: an equi-join over cells, filtered by
the lower bound and verified on the fingerprints, finds all links.

Cells with very many fingerprints (a large group of near copies) are cut finer: their fingerprints are
joined on all choices of six of the eight bytes, which is exact as well, and leaves at most 2**16
different fingerprints in any cell.

Cases: a null text counts as empty and an empty text has fingerprint 0, which links like any other; a
null id takes part and counts as no id, so a component of null ids only has a null component_id; rows
that repeat an id each get a row; further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm.common import stored, whole
from murmura.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Blocks of segments; cells are choices of all but ``DISTANCE`` of them.
BLOCKS = 6
#: Cells with more fingerprints than this are cut finer.
CELL = 2_000
#: Shingles whose bits are counted at a time.
SLICE = 1 << 16

EVEN = 0x5555555555555555


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of the whole text, signed as Spark's long."""
    data = b" ".join(text.encode().lower().split())  # bytes: lowers A-Z and splits at ASCII blanks only
    if not data:
        return 0
    sizes = list(map(len, data.split(b" ")))
    ends = [e - 1 for e in accumulate(n + 1 for n in sizes)]
    starts = [e - n for e, n in zip(ends, sizes)]
    width = min(SHINGLE, len(sizes))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, dtype=np.int64), len(sizes) - width + 1
    for at in range(0, n, SLICE):
        spans = zip(starts[at : min(n, at + SLICE)], ends[at + width - 1 :])
        hashes = np.array([digest(data[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return run(whole(text))


def _long(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def embedded(fp: Column) -> Column:
    """Unary bit counts of the two-bit segments, packed in a long."""
    high = F.shiftrightunsigned(fp, 1)
    one = fp.bitwiseOR(high).bitwiseAND(F.lit(EVEN))
    two = fp.bitwiseAND(high).bitwiseAND(F.lit(EVEN))
    return one.bitwiseOR(F.shiftleft(two, 1))


def block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` runs of two-bit segments, as even as can be."""
    cuts = [32 * i // blocks for i in range(blocks + 1)]
    return [(1 << 2 * b) - (1 << 2 * a) for a, b in zip(cuts, cuts[1:])]


def _cells(points: DataFrame, value: str, masks: list[int]) -> DataFrame:
    """Each point once for every choice of all masks but ``DISTANCE``."""
    keep = [sum(c) for c in combinations(masks, len(masks) - DISTANCE)]
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col(value).bitwiseAND(F.lit(_long(m))).alias("cell"))
            for i, m in enumerate(keep)
        ]
    )
    return points.select("fp", "spot", F.inline(choices))


def _joined(cells: DataFrame) -> DataFrame:
    """Pairs in one cell that pass the lower bound and the exact distance; both are join conditions."""
    left, right = cells.alias("l"), cells.alias("r")
    return left.join(
        right,
        (F.col("l.choice") == F.col("r.choice"))
        & (F.col("l.cell") == F.col("r.cell"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (F.bit_count(F.col("l.spot").bitwiseXOR(F.col("r.spot"))) <= DISTANCE)
        & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= DISTANCE),
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def links(fingerprints: DataFrame, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """All pairs ``a < b`` of the distinct ``fp`` that differ in at most two bits (repeated pairs remain)."""
    points = fingerprints.select("fp", embedded(F.col("fp")).alias("spot"))
    cells = _cells(points, "spot", block_masks(blocks))
    sizes = cells.groupBy("choice", "cell").count().where("count > 1")
    sizes = stored(sizes, "simhash-cells")  # far fewer than the points: most cells hold one
    shared = cells.join(sizes.where(F.col("count") <= cell), ["choice", "cell"], "left_semi")
    found = _joined(shared)
    large = sizes.where(F.col("count") > cell)
    if large.isEmpty():
        return found
    crowded = stored(cells.join(large, ["choice", "cell"], "left_semi").select("fp", "spot").distinct(), "simhash-crowded")
    return found.unionByName(_joined(_cells(crowded, "fp", [0xFF << 8 * i for i in range(8)])))


def grouped(fingerprints: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``fp``, ``root``, ``component_id`` of every distinct fingerprint of ``(doc_id, fp)``."""
    distinct = stored(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(distinct, blocks), "simhash").withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` in hex and ``component_id``, the smallest id it can reach."""
    prints = stored(
        docs.select(docs["doc_id"], fingerprint_column(docs["text"]).alias("fp")), "simhash-fingerprints"
    )
    return prints.join(grouped(prints), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component stays, that of the smallest id; columns as they were."""
    names = docs.columns
    prints = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), fingerprint_column(docs["text"]).alias("fp"))
    prints = stored(prints, "simhash-documents")
    groups = grouped(prints.select(F.col("row.doc_id").alias("doc_id"), "fp"))
    rows = prints.join(groups, "fp").where(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    # Only rows that share the smallest id are left here; they compete by text and the other columns.
    order = Window.partitionBy("root").orderBy(F.xxhash64("row"), F.to_json("row"))
    return rows.withColumn("place", F.row_number().over(order)).where("place = 1").select("row.*")
