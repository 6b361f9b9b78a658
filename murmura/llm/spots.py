"""Document fingerprints from spot signatures, as DataFrame expressions only.

A spot is a common word directly followed by a content word; its signature is the common word with the
chain of the next content words, common words skipped. Words are compared without the punctuation about
them. What no spot covers has signatures too: a content word in no chain gives the pair with the next
content word, and a common word among common ones the pair with the next word, so every stretch of a text
counts, however few spots it has. The set of a document's signatures is its fingerprint; likeness is the
Jaccard similarity of two sets. Near-duplicate search partitions the sets
by length (similar sets have similar lengths), compares within a partition and its neighbour those that
share one of their first signatures, prunes by the lengths and verifies exactly.

Cases: a null text counts as empty; texts without words take their whole text, so any text has a fingerprint and equal texts have equal ones.
Null ids come before all others; rows that repeat id and text are one document: each copy gets the same
values, and the next document is the next different pair of id and text. A single document is its own
next. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm.common import stored, whole, words
from murmura.llm.components import components

#: Content words of a chain.
CHAIN = 2
SIMILARITY = 0.8

# Common words of the four languages of the corpus.
COMMON = (
    "the a an of and to in is are was for on with by that this it as at be from or not have has "
    "der die das den dem des und ein eine ist mit von zu für sich auf im nicht "
    "le la les un une du et dans que est pour en au sur qui "
    "el los las y de por con una al se lo es"
).split()


#: Punctuation before or after the letters and digits of a word; words without any stay as they are.
_MARK, _SIGN, _BLANK = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]", r"[\p{L}\p{M}\p{N}]", r"[^\x20\x09-\x0D]"
EDGES = rf"(?<!{_BLANK}){_MARK}++(?={_SIGN})|(?<={_SIGN}){_MARK}++(?!{_BLANK})"


def _common(word: Column) -> Column:
    return word.isin(COMMON)


def with_signatures(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Add, for each ``text column: name``, the sorted distinct hashes of the spots of its text.

    Every step is a column of its own: inside a lambda the step before would be done for each word.
    """
    columns, names = rows.columns, list(texts.values())
    step = rows.withColumns({f"{n}_w": words(F.regexp_replace(F.lower(F.col(t)), EDGES, "")) for t, n in texts.items()})
    step = step.withColumns({f"{n}_m": F.transform(f"{n}_w", lambda x: F.struct(x.alias("word"), _common(x).alias("common"))) for n in names})

    def content(m: str) -> Column:
        marked = F.transform(
            m,
            lambda x, i: F.struct(
                x["word"].alias("word"), x["common"].alias("common"), F.when(F.get(m, i - 1)["common"], F.get(m, i - 1)["word"]).alias("after")
            ),
        )
        return F.filter(marked, lambda s: ~s["common"])

    step = step.withColumns({f"{n}_c": content(f"{n}_m") for n in names})

    def chains(c: str) -> Column:
        covered = lambda i: reduce(Column.__or__, [F.get(c, i - k)["after"].isNotNull() for k in range(1, CHAIN)])
        hashed = F.transform(
            c,
            lambda s, i: F.when(
                s["after"].isNotNull(), F.xxhash64(s["after"], s["word"], *[F.get(c, i + k)["word"] for k in range(1, CHAIN)])
            ).when(~covered(i), F.xxhash64(F.lit("|"), s["word"], F.get(c, i + 1)["word"])),
        )
        return F.array_compact(hashed)

    def between(m: str) -> Column:
        common = lambda i: F.coalesce(F.get(m, i)["common"], F.lit(True))
        hashed = F.transform(
            m, lambda x, i: F.when(x["common"] & common(i - 1) & common(i + 1), F.xxhash64(F.lit("||"), x["word"], F.get(m, i + 1)["word"]))
        )
        return F.array_compact(hashed)

    def signatures(t: str, n: str) -> Column:
        found = F.sort_array(F.array_distinct(F.concat(chains(f"{n}_c"), between(f"{n}_m"))))
        return F.when(F.size(f"{n}_w") > 0, found).otherwise(F.array(F.xxhash64(F.lit("|||"), F.col(t))))

    return step.select(*columns, *[signatures(t, n).alias(n) for t, n in texts.items()])


def likeness(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def digest(signatures: str) -> Column:
    return F.md5(F.array_join(F.transform(signatures, lambda x: x.cast("string")), ",").cast("binary"))


def _key(doc_id: Column, text: Column) -> Column:
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.hex(F.xxhash64(text)))


def next_keys(docs: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``next_key`` and ``copies`` of each different pair of id and text.

    Ids are ordered by a range shuffle; within a range the next is a window away, and the last of a range
    gets the first of the range after. Only ids and hashes are shuffled.
    """
    keys = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("h"), _key(docs["doc_id"], docs["text"]).alias("key"))
    keys = keys.groupBy("doc_id", "h", "key").agg(F.count("*").alias("copies"))
    ranged = stored(
        keys.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h").withColumn("range", F.spark_partition_id()), "spots-keys"
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    firsts = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "h", "key"))["key"].alias("first"))
    ranges = Window.orderBy("range")  # as many rows as ranges
    after = firsts.select(
        "range", F.coalesce(F.lead("first").over(ranges), F.first("first").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after")
    )
    inner = ranged.withColumn("inner", F.lead("key").over(Window.partitionBy("range").orderBy(*order)))
    return inner.join(F.broadcast(after), "range").select(
        "key", "doc_id", "copies", F.coalesce("inner", "after").alias("next_key")
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Each row's ``doc_id`` and ``text`` with the text of the next document, by two shuffles of the texts."""
    texts = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    following = stored(next_keys(texts), "spots-next")
    rows = texts.select(_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    one = rows
    if following.where("copies > 1").limit(1).count():
        # The first of equal rows, found behind the exchange: both sides then read one shuffle of the texts.
        place = F.lag(F.lit(1)).over(Window.partitionBy("key").orderBy("text"))
        one = rows.withColumn("later", place).where("later is null").drop("later")
    # Renaming comes after the joins: with equal names below, Spark reads one shuffle of the texts twice.
    ahead = (
        following.alias("f")
        .join(one.alias("n"), F.col("f.next_key") == F.col("n.key"))
        .select("f.key", "f.doc_id", F.col("n.text").alias("next_text"))
    )
    return ahead.join(rows, "key").select("doc_id", "text", "next_text")


def compared(docs: DataFrame) -> DataFrame:
    """Per row: the fingerprint of its text, of its edited text, and their likeness.

    The edited text has the last half of its characters replaced by the first as many of the next document.
    """
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs).withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))
    signed = with_signatures(rows, {"text": "own", "edited": "changed", "next_text": "following"})
    return signed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest("own").alias("fingerprint"),
        digest("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id``, the smallest id linked by chains of sets at least ``similarity`` alike.

    Equal sets collapse first. A set's partition is the logarithm of its length to the base of
    1 / similarity; similar sets lie in the same or neighbouring ones. Of two similar sets in the order of
    hashes, the first ``n - ceil(similarity * n) + 1`` signatures share one.
    """
    rows = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    signed = with_signatures(rows, {"text": "spots"}).select("doc_id", digest("spots").alias("set"), "spots")
    signed = stored(signed, "spots-signed")
    sets = signed.groupBy("set").agg(F.first("spots").alias("spots"), F.min("doc_id").alias("first_id"))
    sets = stored(sets, "spots-sets")
    n = F.size("spots")
    band = F.floor(F.log(n.cast("double")) / F.lit(log(1 / similarity))).cast("int")
    heads = sets.select("set", n.alias("n"), band.alias("band"), F.explode(F.slice("spots", 1, (n - F.ceil(n * similarity) + 1).cast("int"))).alias("spot"))
    left = heads.withColumn("part", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    a, b = left.alias("a"), heads.alias("b")
    pairs = a.join(
        b,
        (F.col("a.part") == F.col("b.band")) & (F.col("a.spot") == F.col("b.spot")) & (F.col("a.set") != F.col("b.set"))
        & (F.least("a.n", "b.n") >= similarity * F.greatest("a.n", "b.n"))
        & ((F.col("a.band") != F.col("b.band")) | (F.col("a.set") < F.col("b.set"))),
    ).select(F.least("a.set", "b.set").alias("a"), F.greatest("a.set", "b.set").alias("b")).distinct()
    verified = (
        pairs.join(sets.select(F.col("set").alias("a"), F.col("spots").alias("x")), "a")
        .join(sets.select(F.col("set").alias("b"), F.col("spots").alias("y")), "b")
        .where(likeness("x", "y") >= similarity)
        .select("a", "b")
    )
    roots = components(verified, "spots").withColumnRenamed("node", "set")
    rooted = sets.select("set", "first_id").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    classes = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return signed.select("doc_id", "set").join(rooted.join(classes, "root").select("set", "class_id"), "set").drop("set")
