"""TF-IDF over 1..n-grams with a capped vocabulary.

Fitting cuts texts into words once and counts terms batch by batch (`grams`), with one shuffle per n-gram size, keyed by
term. Scoring has no shuffle at all: the fitted vocabulary is bounded by ``max_features`` and is applied inside each row, or
to batches of stored words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.defaults import MAX_DF, MAX_FEATURES, MIN_DF, NGRAM_RANGE
from murmura.functions.text import tokenize, words
from murmura.operators import grams
from murmura.storage import BROADCAST_ROWS, materialize

# Its functions travel with the job, so executors don't need this package.
cloudpickle.register_pickle_by_value(grams)

VOCABULARY = "term string, term_index int, df bigint, cf bigint, idf double"

# Parts of n-grams that are looked up inside a row; more are joined.
SET_TERMS = 20_000


def tokenized(df: DataFrame, text: str) -> DataFrame:
    """Add ``_tokens``, the words of a text column."""
    return df.withColumn("_tokens", tokenize(F.col(text)))


def worded(df: DataFrame, text: str) -> DataFrame:
    """Add ``_words``, the words of a text column in one string."""
    return df.withColumn("_words", words(F.col(text)))


def with_grams(tokens: DataFrame, min_n: int, max_n: int, output: str = "_terms") -> DataFrame:
    """Add the n-grams of ``_tokens`` as one array."""
    df, sizes = tokens, []
    for n in range(min_n, max_n + 1):
        if n == 1:
            sizes.append("_tokens")
            continue
        df = NGram(n=n, inputCol="_tokens", outputCol=f"_grams_{n}").transform(df)
        sizes.append(f"_grams_{n}")
    joined = F.col(sizes[0]) if len(sizes) == 1 else F.concat(*sizes)
    return df.withColumn(output, joined).drop(*[f"_grams_{n}" for n in range(2, max_n + 1)])


def with_ngrams(df: DataFrame, text: str, min_n: int, max_n: int, output: str = "_terms") -> DataFrame:
    """Add the n-grams of a text column as one array."""
    return with_grams(tokenized(df, text), min_n, max_n, output).drop("_tokens")


def _listed(part: str, terms: list[str]) -> str:
    # Terms are word characters and single blanks, so they need no escapes.
    return f"{part} in ({','.join(chr(39) + t + chr(39) for t in terms)})"


def with_known_grams(tokens: DataFrame, n: int, heads: list[str], tails: list[str], output: str = "_terms") -> DataFrame:
    """Add the n-grams of ``_tokens`` that begin with one of the (n-1)-grams ``heads`` and end with one of ``tails``.

    The others, most of them, are never put together.
    """
    if not heads or not tails:
        return tokens.withColumn(output, F.array().cast("array<string>"))
    parts = "_tokens" if n == 2 else "_parts"
    df = tokens if n == 2 else with_grams(tokens, n - 1, n - 1, parts)
    known = f"if({_listed('a', heads)} and {_listed('b', tails)}, concat(a, ' ', substring_index(b, ' ', -1)), null)"
    put = known if n > 2 else known.replace("substring_index(b, ' ', -1)", "b")
    grams = F.expr(f"array_compact(zip_with({parts}, slice({parts}, 2, size({parts})), (a, b) -> {put}))")
    return df.withColumn(output, grams).drop("_parts")


def term_counts(docs: DataFrame, key: str, terms: str, ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """Occurrences of each term in each document, without a shuffle, since a document is one row.

    ``terms`` is an array of them, whose runs of equal ones are measured inside the row; or the words of each document in
    one string, as `worded` makes it, whose n-grams are counted batch by batch.
    """
    if docs.schema[terms].dataType.simpleString() == "string":
        kind = docs.schema[key].dataType.simpleString()
        return docs.select(key, terms).mapInArrow(grams.occurrences(*ngram_range), f"`{key}` {kind}, term string, tf bigint")
    ordered = docs.select(key, F.sort_array(terms).alias("_sorted")).filter(F.size("_sorted") > 0)
    starts = ordered.select(
        key,
        "_sorted",
        F.filter(
            F.sequence(F.lit(0), F.size("_sorted") - 1),
            lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
        ).alias("_starts"),
    )
    ends = F.concat(F.slice("_starts", 2, F.size("_starts")), F.array(F.size("_sorted")))
    runs = F.zip_with(
        "_starts",
        ends,
        lambda start, end: F.struct(F.get("_sorted", start).alias("term"), (end - start).cast("bigint").alias("tf")),
    )
    return starts.select(key, F.explode_outer(runs).alias("_run")).select(key, "_run.term", "_run.tf")


def corpus_counts(tokens: DataFrame, n: int, frequent: DataFrame | None = None) -> DataFrame:
    """Document and corpus frequency of every n-gram of one size, from a table with ``_words`` or ``_tokens``.

    Batches are counted first, and their counts added up by term. ``frequent`` holds the (n-1)-grams that can
    still matter: an n-gram is never more frequent than the two (n-1)-grams it contains, so all others are
    skipped before the shuffle: inside the batch, or by joins when there are more than ``SET_TERMS`` parts.
    """
    known = None if frequent is None else frequent.select("term")
    parts = None if known is None else [r.term for r in known.limit(SET_TERMS + 1).collect()]
    joined = parts is not None and len(parts) > SET_TERMS
    texts = tokens.select("_words" if "_words" in tokens.columns else F.array_join("_tokens", " "))
    counts = texts.mapInArrow(grams.counting(n, None if joined else parts), grams.COUNTS)
    if joined:
        head = F.substring_index("term", " ", n - 1)
        tail = F.substring_index("term", " ", -(n - 1))
        for part in (head, tail):
            candidates = F.broadcast(known.select(F.col("term").alias("_part")))
            counts = counts.join(candidates, part == F.col("_part"), "left_semi")
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary: terms in code-point order with their document and corpus frequency."""

    terms: list[str]
    df: list[int]
    cf: list[int]
    documents: int
    min_n: int
    max_n: int

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.documents) / (1 + df)) + 1 for df in self.df]

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.terms, range(len(self.terms)), self.df, self.cf, self.idf))
        return spark.createDataFrame(rows, VOCABULARY)

    def _terms(self, tokens: DataFrame) -> DataFrame:
        """Add ``_terms``: the n-grams of ``_tokens`` that can be in the vocabulary, and all words."""
        df, sizes = tokens, []
        for n in range(self.min_n, self.max_n + 1):
            if n == 1:
                sizes.append("_tokens")
                continue
            terms = [t for t in self.terms if t.count(" ") == n - 1]
            heads, tails = {t.rsplit(" ", 1)[0] for t in terms}, {t.split(" ", 1)[1] for t in terms}
            if terms:
                df = with_known_grams(df, n, sorted(heads), sorted(tails), f"_known_{n}")
                sizes.append(f"_known_{n}")
        joined = F.col(sizes[0]) if len(sizes) == 1 else F.concat(*sizes)
        return df.withColumn("_terms", joined).drop(*[c for c in sizes if c != "_tokens"])

    def counts(self, docs: DataFrame, text: str) -> DataFrame:
        """Add ``_index`` and ``_tf``: the vocabulary terms of each text and how often they occur.

        Texts are cut into words, unless ``docs`` has them as ``_tokens``.
        """
        if not self.terms:
            return docs.select(
                "*",
                F.array().cast("array<int>").alias("_index"),
                F.array().cast("array<double>").alias("_tf"),
            )
        terms = self._terms(docs if "_tokens" in docs.columns else tokenized(docs, text))
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_vector")
        vector = F.unwrap_udt("_vector")
        counted = counter.transform(terms).withColumn("_vector", vector)
        return counted.select(
            *docs.columns, F.col("_vector.indices").alias("_index"), F.col("_vector.values").alias("_tf")
        )

    def _products(self) -> Column:
        """tf * idf of the terms in a row."""
        if not self.terms:
            return F.col("_tf")
        idf = F.expr("array(" + ",".join(f"{v!r}D" for v in self.idf) + ")")
        return F.zip_with("_index", "_tf", lambda i, tf: tf * F.get(idf, i))

    def strength(self, docs: DataFrame, text: str = "content_norm") -> DataFrame:
        """Add ``tfidf_strength``: the sum of the L2-normalised weights of a text, 0 without terms.

        Where ``docs`` has the words as ``_words``, they are scored batch by batch, with the same results.
        """
        if "_words" in docs.columns and self.terms:
            score = F.arrow_udf(grams.strength(self.terms, self.idf, self.min_n, self.max_n), "double")
            return docs.withColumn("tfidf_strength", score("_words"))
        weighted = self.counts(docs, text).withColumn("_w", self._products())
        total = F.aggregate("_w", F.lit(0.0), lambda acc, w: acc + w)
        squares = F.aggregate("_w", F.lit(0.0), lambda acc, w: acc + w * w)
        return weighted.select(
            *docs.columns, F.coalesce(F.try_divide(total, F.sqrt(squares)), F.lit(0.0)).alias("tfidf_strength")
        )

    def weights(self, docs: DataFrame, key: str, text: str = "content_norm") -> DataFrame:
        """The sparse matrix as rows: key, term, tf and L2-normalised weight. Texts are cut, unless ``docs`` has ``_words``."""
        kind = docs.schema[key].dataType.simpleString()
        words = (docs if "_words" in docs.columns else worded(docs.select(key, text), text)).select(key, "_words")
        if not self.terms:
            words = words.limit(0)
        run = grams.weights(self.terms, self.idf, self.min_n, self.max_n)
        return words.mapInArrow(run, f"`{key}` {kind}, term string, tf bigint, weight double")


def fit_tfidf(
    docs: DataFrame,
    text: str = "content_norm",
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    max_features: int = MAX_FEATURES,
) -> TfidfModel:
    """Fit the vocabulary: document-frequency limits, then the most frequent terms, ties by term.

    Texts are read and cut into words once; the words are stored, unless ``docs`` is a stored table that has them as
    ``_words``, and each n-gram size is counted over them. Only ``max_features`` rows per size reach the driver, and up to ``SET_TERMS`` parts of the next.
    """
    stored = "_words" in docs.columns
    tokens = docs if stored else materialize(worded(docs.select(text), text).select("_words"), "tokens")
    return fit_tokens(tokens, ngram_range, min_df, max_df, max_features)


def fit_tokens(
    tokens: DataFrame,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
    max_features: int = MAX_FEATURES,
) -> TfidfModel:
    """`fit_tfidf` over a stored table with the words of each text as ``_words`` or ``_tokens``."""
    min_n, max_n = ngram_range
    documents = tokens.count()
    limits = (F.col("df") >= min_df) & (F.col("df") <= max_df * documents)
    kept: list[tuple[str, int, int]] = []
    frequent = None
    for n in range(min_n, max_n + 1):
        counts = corpus_counts(tokens, n, frequent)
        if n < max_n:
            counts = materialize(counts, "term-counts")
        best = counts.filter(limits).orderBy(F.desc("cf"), "term").limit(max_features).collect()
        kept = sorted(kept + [(r.term, r.df, r.cf) for r in best], key=lambda r: (-r[2], r[0]))[:max_features]
        frequent = None
        if n < max_n and len(kept) == max_features:
            candidates = counts.filter(F.col("cf") >= kept[-1][2])
            if candidates.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
                frequent = candidates
    kept.sort()
    return TfidfModel(
        terms=[r[0] for r in kept],
        df=[r[1] for r in kept],
        cf=[r[2] for r in kept],
        documents=documents,
        min_n=min_n,
        max_n=max_n,
    )


def vocabulary(docs: DataFrame, text: str = "content_norm", **limits) -> DataFrame:
    """The fitted terms with document frequency, corpus frequency and inverse document frequency."""
    return fit_tfidf(docs, text, **limits).vocabulary(docs.sparkSession).drop("term_index")
