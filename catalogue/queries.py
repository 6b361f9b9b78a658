"""Every operator as a query over the given tables.

Times are returned as text, lists joined, doubles rounded, and long texts as digests of the
whole text, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.inputs import (
    AS_OF,
    BEARISH,
    BULLISH,
    TOPICS,
    capture,
    cleaned,
    posts,
    raw,
    stored_posts,
)
from murmura.defaults import BOOTSTRAP_SAMPLES, SEED
from murmura.functions import fields, signal, text
from murmura.operators import buckets, clean, dedupe, extract, lookback, report, scoring, tfidf
from murmura.plans.analyze import SIGNAL_COLUMNS, hourly_signals
from murmura.plans.ingest import ingest_posts
from murmura.plans.process import clean_files, process_posts
from murmura.sources import raw as raw_source
from murmura.sources import tables
from murmura.storage import materialize, scratch_path
from murmura.streaming import posts as streaming
from murmura.streaming import sinks

LOOKBACK = (24, 36, 48, 72)
TARGET = 200
# Seven-hour buckets are counted from here; posts before OLD may come late, after those before HALF.
ORIGIN, OLD, HALF = "2024-01-01 03:00:00", "2024-01-08 00:00:00", "2024-01-16 00:00:00"
WIDE_LOOKBACK = (168, 336, 504, 672)


def _time(c: str | Column, name: str | None = None) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or c)


def _hour(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _round(c: str | Column, name: str | None = None) -> Column:
    return F.round(c, 6).alias(name or c)


def _joined(c: str | Column, name: str | None = None) -> Column:
    return F.array_join(c, "|").alias(name or c)


def _digest(c: str | Column, name: str | None = None) -> Column:
    return F.md5(c).alias(name or c)


def _clean_view(df: DataFrame) -> DataFrame:
    return df.select(
        "tweet_id", "username", _time("timestamp"), _digest("content"), _digest("content_norm"),
        "replies", "retweets", "likes", "views", _joined("mentions"), _joined("hashtags"),
        "query_tag", "permalink", "scraped_at", "content_hash", "engagement",
    )


def _raw_view(df: DataFrame) -> DataFrame:
    return df.select(
        "tweet_id", "username", "timestamp", _digest("content"), "replies", "retweets", "likes",
        "views", "mentions", "hashtags", "query_tag", "permalink", "scraped_at",
    )


def _agg_view(df: DataFrame) -> DataFrame:
    return df.select(
        _hour("bucket_start"), "tweet_count", _round("signal_mean"), _round("ci_low"),
        _round("ci_high"), _round("mean_engagement"), _round("mean_likes"),
    )


def _stats_view(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        _hour("bucket_start"), "tweet_count", _round("signal_mean"), _round("mean_engagement"),
        _round("mean_likes"), *more,
    )


def _scored(spark: SparkSession, sf_dir: str, columns: list[str] | None = SIGNAL_COLUMNS) -> DataFrame:
    return scoring.score_posts(stored_posts(spark, sf_dir), BULLISH, BEARISH, columns=columns)


# --- sources and sinks: written and read back


def read_raw_jsonl(spark, sf_dir):
    path = scratch_path(spark, "raw")
    raw_source.append_raw(raw(spark, sf_dir), path, "gzip")
    return _raw_view(raw_source.read_raw(spark, path))


def _cut_lines(spark, sf_dir):
    """Raw files in which some lines break off."""
    path = scratch_path(spark, "raw")
    whole = F.to_json(F.struct(*raw(spark, sf_dir).columns))
    cut = F.when(F.col("likes") == "17", F.lit('{"tweet_id": "1", "content": ')).otherwise(whole)
    raw(spark, sf_dir).select(cut.alias("value")).write.text(path, compression="gzip")
    return path


def read_raw_lenient(spark, sf_dir):
    return _raw_view(raw_source.read_raw(spark, _cut_lines(spark, sf_dir), on_bad="drop"))


def bad_row_counts(spark, sf_dir):
    """How many lines are malformed or without an id, and how many times and numbers are unreadable."""
    return clean_files(spark, _cut_lines(spark, sf_dir))[1]


def append_raw_jsonl(spark, sf_dir):
    path = scratch_path(spark, "raw")
    rows = raw(spark, sf_dir)
    raw_source.append_raw(rows.filter(F.col("query_tag") != ""), path, "gzip")
    raw_source.append_raw(rows.filter(F.col("query_tag") == ""), path, "gzip")
    return _raw_view(raw_source.read_raw(spark, path))


def write_flat_parquet(spark, sf_dir):
    path = scratch_path(spark, "flat")
    tables.write_flat(posts(spark, sf_dir), path)
    return _clean_view(tables.read_posts(spark, path))


def write_partitioned_parquet(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    tables.write_partitioned(posts(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy(F.date_format("date", "yyyy-MM-dd").alias("date"), "hashtag").agg(
        F.count("*").alias("posts"),
        F.countDistinct("query_tag").alias("tags"),
        F.sum("engagement").alias("engagement"),
    )


def sample_head(spark, sf_dir):
    return _clean_view(tables.sample_head(posts(spark, sf_dir)))


def write_sample_files(spark, sf_dir):
    parquet, csv = scratch_path(spark, "sample"), scratch_path(spark, "sample_csv")
    tables.write_sample(posts(spark, sf_dir), parquet, csv)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(csv)
    return back.select(
        "tweet_id", _digest("content"), F.col("likes").cast("bigint").alias("likes"),
        _joined(F.from_json("hashtags", "array<string>"), "hashtags"),
    )


def write_agg_csv(spark, sf_dir):
    path = scratch_path(spark, "agg")
    tables.write_agg(materialize(buckets.aggregate_signals(_scored(spark, sf_dir)), "agg"), path)
    back = spark.read.option("header", True).schema(
        "bucket_start timestamp, tweet_count bigint, signal_mean double, ci_low double, "
        "ci_high double, mean_engagement double, mean_likes double"
    ).csv(path)
    return _agg_view(back)


def write_scored_parquet(spark, sf_dir):
    path = scratch_path(spark, "scored")
    tables.write_scored(_scored(spark, sf_dir, columns=None), path)
    return _scored_view(spark.read.parquet(path))


def write_vocabulary(spark, sf_dir):
    path = scratch_path(spark, "vocabulary")
    tables.write_vocabulary(tfidf.vocabulary(stored_posts(spark, sf_dir)), path)
    return spark.read.text(path).select(F.col("value").alias("term"))


def write_summary(spark, sf_dir):
    path = scratch_path(spark, "summary")
    tables.write_summary(report.summary(_scored(spark, sf_dir)), path)
    back = spark.read.schema(
        "tweets bigint, mean_signal double, bullish_share double, bearish_share double, hashtags array<string>"
    ).json(path)
    return _summary_view(back)


# --- field extraction


def extract_post_id(spark, sf_dir):
    return extract.extract_posts(capture(spark, sf_dir)).select("scraped_at", "tweet_id")


def extract_username(spark, sf_dir):
    return capture(spark, sf_dir).select("scraped_at", fields.username(F.col("user_block")).alias("username"))


def parse_count(spark, sf_dir):
    labels = ["reply_label", "retweet_label", "like_label", "views_label"]
    return capture(spark, sf_dir).select(
        "scraped_at",
        *[fields.parse_count(F.col(c)).alias(c) for c in labels],
        fields.parse_count(F.col("like_label"), strict_suffix=True).alias("strict_likes"),
    )


def extract_mentions(spark, sf_dir):
    return capture(spark, sf_dir).select("scraped_at", _joined(fields.mentions(F.col("content")), "mentions"))


def extract_hashtags(spark, sf_dir):
    return capture(spark, sf_dir).select("scraped_at", _joined(fields.hashtags(F.col("content")), "hashtags"))


def extract_posts(spark, sf_dir):
    return extract.extract_posts(capture(spark, sf_dir)).select(
        "tweet_id", "username", "timestamp", _digest("content"), "replies", "retweets", "likes", "views",
        _joined("mentions"), _joined("hashtags"), "query_tag", "permalink", "scraped_at",
    )


def _extracted(spark, sf_dir):
    return extract.extract_posts(capture(spark, sf_dir)).withColumn(
        "timestamp", fields.parse_timestamp(F.col("timestamp"))
    )


def topic_filter(spark, sf_dir):
    found = extract.topic_filter(_extracted(spark, sf_dir), TOPICS, AS_OF, lookback_hours=180)
    return found.select("scraped_at", "tweet_id", _time("timestamp"), _joined("hashtags"))


def assign_topic(spark, sf_dir):
    return extract.assign_topic(_extracted(spark, sf_dir), TOPICS).select("scraped_at", "tweet_id", "query_tag")


# --- scalar functions


def normalize_text(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "scraped_at",
        _digest(text.normalize_text(F.col("content")), "content"),
        text.normalize_text(F.col("username")).alias("username"),
    )


def casefold(spark, sf_dir):
    return raw(spark, sf_dir).select("scraped_at", _digest(text.casefold(F.col("content")), "folded"))


def clean_arrays(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "scraped_at",
        _joined(text.clean_array(text.text_items(F.col("mentions")), "@"), "mentions"),
        _joined(text.clean_array(text.text_items(F.col("hashtags")), "#", folded=True), "hashtags"),
    )


def int_or_zero(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "scraped_at", *[fields.int_or_zero(F.col(c)).alias(c) for c in clean.COUNTS]
    )


def content_hash(spark, sf_dir):
    return cleaned(spark, sf_dir).select("scraped_at", "content_hash")


def parse_timestamp(spark, sf_dir):
    return raw(spark, sf_dir).select("scraped_at", _time(fields.parse_timestamp(F.col("timestamp")), "timestamp"))


def date_partition(spark, sf_dir):
    return tables.with_partitions(cleaned(spark, sf_dir)).select("scraped_at", "date", "hashtag")


def clean_rows(spark, sf_dir):
    return _clean_view(cleaned(spark, sf_dir))


def lexicon_score(spark, sf_dir):
    score = signal.lexicon_score(F.col("content_norm"), BULLISH, BEARISH)
    return cleaned(spark, sf_dir).select("scraped_at", _round(score, "lexicon_score"))


def engagement_weight(spark, sf_dir):
    weight = signal.engagement_weight(F.col("engagement"))
    return cleaned(spark, sf_dir).select("scraped_at", _round(weight, "engagement_weight"))


def tweet_signal(spark, sf_dir):
    return _scored(spark, sf_dir).select("tweet_id", _round("tweet_signal"))


# --- filters


def drop_invalid(spark, sf_dir):
    return clean.drop_invalid(cleaned(spark, sf_dir)).select("scraped_at", "tweet_id", _time("timestamp"))


def widening_lookback(spark, sf_dir):
    kept = lookback.widening_lookback(stored_posts(spark, sf_dir), AS_OF, LOOKBACK, TARGET)
    return kept.select("tweet_id", _time("timestamp"))


def widening_lookback_fallback(spark, sf_dir):
    kept = lookback.widening_lookback(stored_posts(spark, sf_dir), AS_OF, LOOKBACK, target=10**12)
    return kept.select("tweet_id", _time("timestamp"))


def fixed_lookback(spark, sf_dir):
    return lookback.fixed_lookback(posts(spark, sf_dir), AS_OF, 36).select("tweet_id", _time("timestamp"))


def take_target(spark, sf_dir):
    valid = raw(spark, sf_dir).filter(F.col("tweet_id") != "")
    return lookback.take_target(valid, 500).select("tweet_id", "scraped_at", _digest("content"))


def latest_n(spark, sf_dir):
    return lookback.latest(posts(spark, sf_dir), 250).select("tweet_id", _time("timestamp"))


# --- duplicates


def dedupe_by_id(spark, sf_dir):
    return _clean_view(dedupe.dedupe_by_id(clean.drop_invalid(cleaned(spark, sf_dir))))


def dedupe_by_content(spark, sf_dir):
    return _clean_view(dedupe.dedupe_by_content(dedupe.dedupe_by_id(clean.drop_invalid(cleaned(spark, sf_dir)))))


def clean_and_dedupe(spark, sf_dir):
    return _clean_view(posts(spark, sf_dir))


def incremental_new_posts(spark, sf_dir):
    incoming = raw(spark, sf_dir)
    existing = incoming.filter(F.col("query_tag") == " CLICK ")
    return dedupe.new_posts(incoming, existing).select("tweet_id", "scraped_at", _digest("content"))


def ingest_resumed(spark, sf_dir):
    """Two runs: the first takes 300 posts, the second adds unknown ones up to 800 in all."""
    path, seen = scratch_path(spark, "ingested"), capture(spark, sf_dir)
    ingest_posts(seen.filter(F.col("scraped_at").endswith("3")), path, target=300, resume=False)
    return ingest_posts(seen, path, target=800).select("tweet_id", "scraped_at", _digest("content"))


# --- text features


def tokenize(spark, sf_dir):
    return posts(spark, sf_dir).select(
        "tweet_id", _digest(F.array_join(text.tokenize(F.col("content_norm")), " "), "tokens")
    )


def ngrams(spark, sf_dir):
    grams = tfidf.with_ngrams(posts(spark, sf_dir).select("tweet_id", "content_norm"), "content_norm", 1, 2)
    joined = _digest(F.array_join("_terms", "|"), "ngrams")
    return grams.select("tweet_id", F.size("_terms").cast("bigint").alias("n"), joined)


def term_counts(spark, sf_dir):
    """Counts per post and term, then the profile of each post."""
    docs = tfidf.worded(posts(spark, sf_dir).select("tweet_id", "content_norm"), "content_norm")
    return (
        tfidf.term_counts(docs, "tweet_id", "_words", (1, 2))
        .groupBy("tweet_id")
        .agg(
            F.count("*").alias("terms"),
            F.sum("tf").alias("occurrences"),
            F.max("tf").alias("max_tf"),
            F.sum(F.col("tf") * F.length("term")).alias("letters"),
            F.sum(F.col("tf") * F.ascii("term")).alias("initials"),
        )
    )


def vocabulary(spark, sf_dir):
    return tfidf.vocabulary(stored_posts(spark, sf_dir)).select("term", "df", "cf", _round("idf"))


def tfidf_weights(spark, sf_dir):
    """Weights per post and term, then their profile per term."""
    words = tfidf.worded(stored_posts(spark, sf_dir), "content_norm").select("tweet_id", "_words")
    stored = materialize(words, "tokens")
    weights = tfidf.fit_tfidf(stored).weights(stored, "tweet_id")
    return weights.groupBy("term").agg(
        F.count("*").alias("posts"),
        F.sum("tf").alias("tf"),
        _round(F.sum("weight"), "weight"),
        _round(F.max("weight"), "max_weight"),
    )


def tfidf_strength(spark, sf_dir):
    stored = stored_posts(spark, sf_dir)
    return tfidf.fit_tfidf(stored).strength(stored).select("tweet_id", _round("tfidf_strength"))


def _scored_view(df):
    return df.select(
        "tweet_id", _time("timestamp"), "query_tag", "engagement", "likes", _digest("content_norm"),
        _round("lexicon_score"), _round("tfidf_strength"), _round("engagement_weight"), _round("tweet_signal"),
    )


def score_posts(spark, sf_dir):
    return _scored_view(_scored(spark, sf_dir, columns=None))


# --- aggregates


def bucket_stats(spark, sf_dir):
    return _stats_view(buckets.bucket_stats(_scored(spark, sf_dir)))


def bucket_stats_7h(spark, sf_dir):
    return _stats_view(buckets.bucket_stats(_scored(spark, sf_dir), "7 hours"))


def hourly_signals_query(spark, sf_dir):
    return _agg_view(hourly_signals(stored_posts(spark, sf_dir), BULLISH, BEARISH))


def bootstrap_ci(spark, sf_dir):
    return _agg_view(buckets.bootstrap_ci(_scored(spark, sf_dir), "1 day"))


def bootstrap_ci_exact(spark, sf_dir):
    return _agg_view(buckets.bootstrap_ci_exact(_scored(spark, sf_dir), "1 day"))


def bootstrap_ci_mixed(spark, sf_dir):
    """Buckets of one post and of many, by one method."""
    return _agg_view(buckets.bootstrap_ci_exact(_scored(spark, sf_dir)))


def bootstrap_cells(spark, sf_dir):
    """Exact resampling with each bucket split over many cells: all draws are made, and means are covered."""
    scored = _scored(spark, sf_dir)
    stats = buckets.bucket_stats(scored, "1 day")
    cells = buckets.cells_of(scored, "1 day", cell_posts=20)
    made = buckets.cell_draws(cells, BOOTSTRAP_SAMPLES, SEED).groupBy("bucket_start").agg(F.sum("k").alias("draws"))
    ci = buckets.bootstrap_ci_exact(scored, "1 day", cell_posts=20).select("bucket_start", "ci_low", "ci_high")
    covered = F.col("signal_mean").between(F.col("ci_low") - 1e-9, F.col("ci_high") + 1e-9)
    joined = stats.join(made, "bucket_start").join(ci, "bucket_start")
    return joined.select(_hour("bucket_start"), "tweet_count", _round("signal_mean"), "draws", covered.alias("covered"))


def ci_series(spark, sf_dir):
    series = buckets.ci_series(buckets.bootstrap_ci(_scored(spark, sf_dir), replicates=100))
    return series.select(_hour("bucket_start"), _round("signal_mean"), _round("ci_low"), _round("ci_high"))


def _summary_view(df):
    return df.select(
        "tweets", _round("mean_signal"), _round("bullish_share"), _round("bearish_share"), _joined("hashtags")
    )


def summary(spark, sf_dir):
    return _summary_view(report.summary(_scored(spark, sf_dir)))


def tag_means(spark, sf_dir):
    return report.tag_means(_scored(spark, sf_dir)).select("query_tag", _round("mean_signal"))


def _histogram_view(df):
    return df.select("bin", _round("bin_low"), _round("bin_high"), "count")


def engagement_histogram(spark, sf_dir):
    values = materialize(posts(spark, sf_dir).select("engagement"), "engagement")
    return _histogram_view(report.histogram(values, "engagement"))


def sampled_histogram(spark, sf_dir):
    sample = report.sample_rows(posts(spark, sf_dir).select("tweet_id", "engagement"))
    sample = materialize(sample, "sample")  # the edges and the counts read it
    return _histogram_view(report.histogram(sample, "engagement"))


def sample_rows(spark, sf_dir):
    return report.sample_rows(posts(spark, sf_dir)).select("tweet_id", "engagement")


def posts_to_hourly_signals(spark, sf_dir):
    """Raw posts to aggregated signals: the whole job."""
    kept = process_posts(raw(spark, sf_dir), AS_OF, WIDE_LOOKBACK)
    return _agg_view(hourly_signals(kept, BULLISH, BEARISH))


# --- streams, drained and compared with the batch result


def _landed(spark, sf_dir):
    path = scratch_path(spark, "landing")
    raw_source.append_raw(raw(spark, sf_dir), path, "gzip")
    return path


def _drain(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def stream_raw(spark, sf_dir):
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    _drain(streaming.flat_sink(streaming.stream_raw(spark, _landed(spark, sf_dir), 4), out, mark))
    return _raw_view(spark.read.parquet(out))


def stream_dedupe(spark, sf_dir):
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    arriving = streaming.stream_clean(streaming.stream_raw(spark, _landed(spark, sf_dir)))
    _drain(streaming.flat_sink(streaming.stream_dedupe(arriving), out, mark))
    return spark.read.parquet(out).select("tweet_id")


def _lexicon_scored(posts: DataFrame) -> DataFrame:
    score = signal.lexicon_score(F.col("content_norm"), BULLISH, BEARISH)
    return posts.withColumn("tweet_signal", score * signal.engagement_weight(F.col("engagement")))


def stream_hourly(spark, sf_dir):
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    arriving = streaming.stream_clean(streaming.stream_raw(spark, _landed(spark, sf_dir)))
    scored = _lexicon_scored(arriving)

    def store(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite").parquet(out)

    writer = streaming.stream_hourly(scored).writeStream.outputMode("complete").foreachBatch(store)
    _drain(writer.option("checkpointLocation", mark))
    return _stats_view(spark.read.parquet(out))


def stream_hourly_7h(spark, sf_dir):
    """Seven-hour buckets of a stream, counted from the origin that the batch is given too."""
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    scored = _lexicon_scored(streaming.stream_clean(streaming.stream_raw(spark, _landed(spark, sf_dir))))

    def store(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite").parquet(out)

    writer = streaming.stream_hourly(scored, "7 hours", origin=ORIGIN).writeStream.outputMode("complete").foreachBatch(store)
    _drain(writer.option("checkpointLocation", mark))
    return _stats_view(spark.read.parquet(out))


def bucket_stats_7h_origin(spark, sf_dir):
    """The batch result that `stream_hourly_7h` equals."""
    scored = _lexicon_scored(clean.drop_invalid(cleaned(spark, sf_dir)))
    return _stats_view(buckets.bucket_stats(scored, "7 hours", ORIGIN))


def stream_hourly_append(spark, sf_dir):
    """Hourly buckets written when they close, scored by a frozen model, and the posts that came too late.

    Three runs with one checkpoint: posts of the first half, then the second half with old posts among it, then
    a post far ahead that closes every bucket.
    """
    landing, out, mark = (scratch_path(spark, name) for name in ("landing", "stream", "mark"))
    model = scoring.fit_signal_model(stored_posts(spark, sf_dir))
    posted, seen = raw(spark, sf_dir), fields.parse_timestamp(F.col("timestamp"))
    late = F.coalesce((seen < F.lit(OLD).cast("timestamp")) & (F.col("likes").cast("int") % 10 == 3), F.lit(False))
    early = ~late & F.coalesce(seen < F.lit(HALF).cast("timestamp"), F.lit(True))
    closing = posted.limit(1).withColumns({"timestamp": F.lit("2024-03-31 12:00:00"), "tweet_id": F.lit("closing")})
    for wave in (posted.where(early), posted.where(~early), closing):
        raw_source.append_raw(wave, landing, "gzip")
        arriving = streaming.stream_clean(streaming.stream_raw(spark, landing))
        scored = streaming.stream_score(arriving, model, BULLISH, BEARISH)
        _drain(streaming.flat_sink(streaming.stream_hourly(scored), out, mark))
    written = spark.read.parquet(out)
    arrived = clean.drop_invalid(cleaned(spark, sf_dir))
    late_posts = streaming.late_counts(arrived, written)
    joined = written.join(late_posts, "bucket_start", "full").withColumns(
        {"tweet_count": F.coalesce("tweet_count", F.lit(0)), "late": F.coalesce("late", F.lit(0))}
    )
    return _stats_view(joined, "late")


def stream_dedupe_resumed(spark, sf_dir):
    """Captured elements to raw posts: two checkpoints over one folder, several batches, two targets."""
    folder, ids = scratch_path(spark, "ingested"), scratch_path(spark, "ids")
    seen, number = capture(spark, sf_dir), F.col("scraped_at").cast("bigint")
    third = seen.agg(F.ceil((F.max(number) + 1) / 3)).first()[0]
    for run, target in ((seen.filter(F.col("scraped_at").endswith("3")), 300), (seen, 800)):
        landing, mark = scratch_path(spark, "landing"), scratch_path(spark, "mark")
        for k in range(3):  # in the order of collection, a batch for each
            run.where(F.floor(number / third) == k).write.mode("append").json(landing, compression="gzip")
            sinks.ingest_stream(sinks.stream_capture(spark, landing), folder, ids, mark, target)
    return raw_source.read_raw(spark, folder, on_bad="drop").select("tweet_id", "scraped_at", _digest("content"))


def stream_latest(spark, sf_dir):
    """Keep-last by id and text over batches with later copies, one of them handed over twice."""
    landing, mark = scratch_path(spark, "landing"), scratch_path(spark, "mark")
    whole = raw(spark, sf_dir)
    sink = sinks.LatestPosts(spark, scratch_path(spark, "latest"), clean.clean_rows(whole).schema, gather_every=2)
    wave = F.pmod(F.xxhash64("scraped_at"), F.lit(3))

    def twice(batch: DataFrame, run: str, number: int) -> None:
        for _ in range(2 if number == 1 else 1):
            sink(batch, run, number)

    for k in (2, 0, 1):
        raw_source.append_raw(whole.where(wave == k), landing, "gzip")
        _drain(sinks.each_batch(streaming.stream_clean(streaming.stream_raw(spark, landing)), mark, twice))
    return _clean_view(sink.posts())


def stream_partitioned_batches(spark, sf_dir):
    """Dated folders filled batch by batch, one of them twice, and the days of the first half closed in between."""
    landing, mark = scratch_path(spark, "landing"), scratch_path(spark, "mark")
    whole = raw(spark, sf_dir)
    sink = sinks.PartitionedPosts(spark, scratch_path(spark, "partitioned"), clean.clean_rows(whole).schema)

    def twice(batch: DataFrame, run: str, number: int) -> None:
        sink(batch, run, number)
        sink(batch, run, number)

    for k in range(2):
        raw_source.append_raw(whole.where(F.pmod(F.xxhash64("scraped_at"), F.lit(2)) == k), landing, "gzip")
        _drain(sinks.each_batch(streaming.stream_clean(streaming.stream_raw(spark, landing)), mark, twice))
        sink.close(HALF[:10])
    return sink.posts().groupBy("date", "hashtag").agg(
        F.count("*").alias("posts"),
        F.countDistinct("query_tag").alias("tags"),
        F.sum("engagement").alias("engagement"),
    )


def stream_score(spark, sf_dir):
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    model = scoring.fit_signal_model(stored_posts(spark, sf_dir))
    arriving = streaming.stream_clean(streaming.stream_raw(spark, _landed(spark, sf_dir)))
    scored = streaming.stream_score(arriving, model, BULLISH, BEARISH).select("scraped_at", "tfidf_strength", "tweet_signal")
    _drain(streaming.flat_sink(scored, out, mark))
    return spark.read.parquet(out).select("scraped_at", _round("tfidf_strength"), _round("tweet_signal"))


def stream_partitioned_sink(spark, sf_dir):
    out, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    arriving = streaming.stream_clean(streaming.stream_raw(spark, _landed(spark, sf_dir)))
    _drain(streaming.partitioned_sink(arriving, out, mark))
    return spark.read.parquet(out).groupBy(F.date_format("date", "yyyy-MM-dd").alias("date"), "hashtag").agg(
        F.count("*").alias("posts"),
        F.countDistinct("query_tag").alias("tags"),
        F.sum("engagement").alias("engagement"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_raw_jsonl": read_raw_jsonl,
    "read_raw_lenient": read_raw_lenient,
    "bad_row_counts": bad_row_counts,
    "append_raw_jsonl": append_raw_jsonl,
    "write_flat_parquet": write_flat_parquet,
    "write_partitioned_parquet": write_partitioned_parquet,
    "sample_head": sample_head,
    "write_sample_files": write_sample_files,
    "write_agg_csv": write_agg_csv,
    "write_scored_parquet": write_scored_parquet,
    "write_vocabulary": write_vocabulary,
    "write_summary": write_summary,
    "extract_post_id": extract_post_id,
    "extract_username": extract_username,
    "parse_count": parse_count,
    "extract_mentions": extract_mentions,
    "extract_hashtags": extract_hashtags,
    "extract_posts": extract_posts,
    "topic_filter": topic_filter,
    "assign_topic": assign_topic,
    "normalize_text": normalize_text,
    "casefold": casefold,
    "clean_arrays": clean_arrays,
    "int_or_zero": int_or_zero,
    "content_hash": content_hash,
    "parse_timestamp": parse_timestamp,
    "date_partition": date_partition,
    "clean_rows": clean_rows,
    "lexicon_score": lexicon_score,
    "engagement_weight": engagement_weight,
    "tweet_signal": tweet_signal,
    "drop_invalid": drop_invalid,
    "widening_lookback": widening_lookback,
    "widening_lookback_fallback": widening_lookback_fallback,
    "fixed_lookback": fixed_lookback,
    "take_target": take_target,
    "latest_n": latest_n,
    "dedupe_by_id": dedupe_by_id,
    "dedupe_by_content": dedupe_by_content,
    "clean_and_dedupe": clean_and_dedupe,
    "incremental_new_posts": incremental_new_posts,
    "ingest_resumed": ingest_resumed,
    "tokenize": tokenize,
    "ngrams": ngrams,
    "term_counts": term_counts,
    "vocabulary": vocabulary,
    "tfidf_weights": tfidf_weights,
    "tfidf_strength": tfidf_strength,
    "score_posts": score_posts,
    "bucket_stats": bucket_stats,
    "bucket_stats_7h": bucket_stats_7h,
    "hourly_signals": hourly_signals_query,
    "bootstrap_ci": bootstrap_ci,
    "bootstrap_ci_exact": bootstrap_ci_exact,
    "bootstrap_ci_mixed": bootstrap_ci_mixed,
    "bootstrap_cells": bootstrap_cells,
    "ci_series": ci_series,
    "summary": summary,
    "tag_means": tag_means,
    "engagement_histogram": engagement_histogram,
    "sampled_histogram": sampled_histogram,
    "sample_rows": sample_rows,
    "posts_to_hourly_signals": posts_to_hourly_signals,
    "stream_raw": stream_raw,
    "stream_dedupe": stream_dedupe,
    "stream_hourly": stream_hourly,
    "stream_hourly_7h": stream_hourly_7h,
    "bucket_stats_7h_origin": bucket_stats_7h_origin,
    "stream_hourly_append": stream_hourly_append,
    "stream_dedupe_resumed": stream_dedupe_resumed,
    "stream_latest": stream_latest,
    "stream_partitioned_batches": stream_partitioned_batches,
    "stream_score": stream_score,
    "stream_partitioned_sink": stream_partitioned_sink,
}
