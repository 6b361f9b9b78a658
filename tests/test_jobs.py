"""Files, streams, whole jobs, and the queries against SQL."""

import json
import os
from datetime import datetime, timedelta

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__
from catalogue.queries import QUERIES
from catalogue.compare import connect, differences
from catalogue.inputs import BEARISH, BULLISH, posts, raw
from murmura.operators.clean import clean_and_dedupe
from murmura.operators.lookback import widening_lookback
from murmura.operators.scoring import fit_signal_model
from murmura.plans.analyze import analyze_posts, write_analysis
from murmura.plans.ingest import ingest_posts
from murmura.plans.process import process_posts, write_processed
from murmura.schemas import CAPTURE, RAW_TEXT
from murmura.sources.raw import append_raw, read_raw
from murmura.sources.tables import read_posts, write_agg, write_flat, write_partitioned
from murmura.storage import Scratch, broadcast_if_small, materialize, scratch_folder
from murmura.streaming import posts as streaming

SF = "/root/testdata/sf0.001"


def test_read_raw(spark, tmp_path):
    good = {"tweet_id": 1, "content": "शेयर", "likes": "3", "mentions": ["a"], "hashtags": "x"}
    (tmp_path / "tweets_a.jsonl").write_text(json.dumps(good, ensure_ascii=False) + "\n\n" + '{"tweet_id": ""}\n', encoding="utf-8")
    (tmp_path / "other.txt").write_text("no json", encoding="utf-8")
    got = read_raw(spark, str(tmp_path), pattern="tweets_*.jsonl").orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.content, r.likes, r.mentions, r.hashtags) for r in got] == [("", None, None, None, None), ("1", "शेयर", "3", '["a"]', "x")]
    (tmp_path / "tweets_b.jsonl").write_text('{"tweet_id": \n{"tweet_id": "2"}\n', encoding="utf-8")
    lenient = read_raw(spark, str(tmp_path), on_bad="drop", pattern="tweets_*.jsonl")
    assert lenient.count() == 2 and {r.tweet_id for r in lenient.collect()} == {"1", "2"}
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_raw(spark, str(tmp_path), pattern="tweets_*.jsonl").collect()


def test_append_keeps_text_unescaped(spark, tmp_path):
    path = str(tmp_path / "r")
    df = raw(spark, SF).limit(3).withColumn("content", F.lit("é शेयर"))
    append_raw(df, path)
    append_raw(df.limit(0), path)
    assert read_raw(spark, path).count() == 3
    lines = "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in os.listdir(path) if f.endswith(".json"))
    assert "é शेयर" in lines


def table(spark, tags):
    rows = [(str(i), datetime(2026, 1, 1) + timedelta(days=i), t) for i, t in enumerate(tags)]
    return spark.createDataFrame(rows, "tweet_id string, timestamp timestamp, query_tag string")


def test_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "p")
    write_partitioned(table(spark, ["a", "", None]), path)
    assert os.path.isdir(f"{path}/date=2026-01-01/hashtag=a") and os.path.isdir(f"{path}/date=2026-01-02/hashtag=unknown")
    write_partitioned(table(spark, ["a"]).withColumn("tweet_id", F.lit("new")), path)
    got = {r.tweet_id for r in spark.read.parquet(path).collect()}
    assert got == {"new", "1", "2"}
    plan = spark.read.parquet(path).filter("date = '2026-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    files = [f for _, _, fs in os.walk(f"{path}/date=2026-01-01") for f in fs if f.endswith(".parquet")]
    assert len(files) == 1 and "zstd" in files[0]


def test_empty_table_keeps_schema(spark, tmp_path):
    path = str(tmp_path / "e")
    write_flat(table(spark, ["a"]).limit(0), path)
    assert spark.read.parquet(path).columns == ["tweet_id", "timestamp", "query_tag"]
    with pytest.raises(ValueError):
        read_posts(spark, path)


def test_agg_csv_layout(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2026, 8, 3, 4), 2, 0.5)], "bucket_start timestamp, tweet_count bigint, signal_mean double")
    write_agg(df, str(tmp_path / "a"), str(tmp_path / "b"))
    for place in "ab":
        name = next(f for f in os.listdir(tmp_path / place) if f.endswith(".csv"))
        lines = (tmp_path / place / name).read_text().splitlines()
        assert lines == ["bucket_start,tweet_count,signal_mean", "2026-08-03 04:00:00.000000+00:00,2,0.5"]


def test_storage(spark):
    assert scratch_folder(spark)
    df = spark.range(10)
    assert materialize(df, "t").count() == 10
    assert "broadcast" in broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 9)._jdf.queryExecution().logical().toString().lower()


def test_scratch_tables_go(spark, tmp_path):
    scratch = Scratch(spark, "job")
    df = scratch.keep(spark.range(5), "t")
    first = scratch.paths["t"]
    df = scratch.keep(df.where("id > 1"), "t")  # reads the table that it replaces
    assert df.count() == 3 and not os.path.exists(first.removeprefix("file:"))
    scratch.drop("t", "unknown")
    assert not scratch.paths


def test_whole_job(spark, tmp_path):
    kept = process_posts(raw(spark, SF), "2024-01-31 00:00:00", target=10)
    flat = write_processed(kept, str(tmp_path / "processed"))
    stored = read_posts(spark, flat)
    result = analyze_posts(stored, BULLISH, BEARISH)
    write_analysis(result, str(tmp_path / "out"))
    n = stored.count()
    assert 10 <= n < posts(spark, SF).count()
    s = json.loads("".join(open(tmp_path / "out" / "summary" / f).read() for f in os.listdir(tmp_path / "out" / "summary") if f.endswith(".json")))
    assert s["tweets"] == n and result.aggregated.agg(F.sum("tweet_count")).first()[0] == n
    assert all(r.ci_low <= r.signal_mean <= r.ci_high for r in result.series.collect())
    weighted = result.aggregated.agg(F.sum(F.col("tweet_count") * F.col("signal_mean")) / n).first()[0]
    assert weighted == pytest.approx(s["mean_signal"])
    terms = [r.value for r in spark.read.text(str(tmp_path / "out" / "vocabulary")).collect()]
    assert terms == sorted(terms) and len(terms) == result.vocabulary.count()


@pytest.mark.parametrize("target", [2, 3, 100])
def test_old_posts_go_before_cleaning(spark, target):
    """Copies of ids and texts on both sides of the boundary; the last target is out of reach."""
    def post(key, day, content):
        return (key, "u", f"2026-01-{day:02d} 12:00:00", content, "0", "0", "0", "0", "[]", "[]", "t", "p", f"{day:04d}")

    rows = [
        post("1", 1, "a"), post("1", 20, "b"), post("2", 2, "b"), post("3", 19, "c"), post("4", 3, "c"),
        post("5", 4, "d"), post("6", 18, "e"), post("7", 18, "e"), post("8", 5, "f"), post("8", 6, "g"),
    ]
    frame = spark.createDataFrame(rows, RAW_TEXT)
    as_of, hours = "2026-01-21 00:00:00", (24, 48, 72)
    whole = widening_lookback(materialize(clean_and_dedupe(frame), "whole"), as_of, hours, target)
    got = process_posts(frame, as_of, hours, target)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert got.count() == {2: 2, 3: 3, 100: 5}[target]


def test_ingest_counts_stored_posts(spark, tmp_path):
    rows = [(f"https://x.example/u/status/{i // 2}", "2026-01-01", "@u", f"text {i}", "", "", "", "", "t", f"{i:03d}") for i in range(40)]
    seen, folder = spark.createDataFrame(rows, CAPTURE), str(tmp_path / "raw")
    assert ingest_posts(seen.where("scraped_at < '010'"), folder, target=3, resume=False).count() == 3
    with open(tmp_path / "raw" / "broken.json", "w") as f:
        f.write('{"tweet_id": "1\n')
    stored = ingest_posts(seen, folder, target=8)
    assert sorted(int(r.tweet_id) for r in stored.collect()) == list(range(8))
    assert ingest_posts(seen, folder, target=5).count() == 8


def drain(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_stream_resumes_without_repeating(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("landing", "out", "mark"))
    rows = raw(spark, SF)
    for part in ("query_tag = ''", "query_tag <> ''"):
        append_raw(rows.filter(part), landing)
        arriving = streaming.stream_dedupe(streaming.stream_clean(streaming.stream_raw(spark, landing)))
        drain(streaming.flat_sink(arriving.select("tweet_id", "timestamp"), out, mark))
    got = [r.tweet_id for r in spark.read.parquet(out).collect()]
    # the first part moves the watermark to three days before its newest post
    late = spark.read.parquet(out).agg(F.min("timestamp")).first()[0]
    assert len(got) == len(set(got)) and late is not None


def test_stream_hourly_append(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("landing", "out", "mark"))
    append_raw(raw(spark, SF), landing)
    scored = streaming.stream_clean(streaming.stream_raw(spark, landing)).withColumn("tweet_signal", F.lit(0.5))
    drain(streaming.flat_sink(streaming.stream_hourly(scored), out, mark))
    newest = spark.read.parquet(out).agg(F.max("bucket_start")).first()[0]
    # buckets still open behind the watermark are not written yet
    assert datetime(2024, 1, 26) < newest < datetime(2024, 1, 28)


@pytest.mark.parametrize("key", ["read_raw_jsonl", "append_raw_jsonl"])
def test_raw_files_are_packed(spark, key):
    found = QUERIES[key](spark, SF)
    assert found.count() == 1000 and all(f.endswith(".json.gz") for f in found.inputFiles())


def test_stream_score_is_stateless(spark, tmp_path):
    landing = str(tmp_path / "landing")
    append_raw(raw(spark, SF).limit(50), landing)
    model = fit_signal_model(materialize(posts(spark, SF), "clean"))
    scored = streaming.stream_score(streaming.stream_clean(streaming.stream_raw(spark, landing)), model)
    assert scored.isStreaming
    drain(streaming.flat_sink(scored.select("tweet_id", "tweet_signal"), str(tmp_path / "o"), str(tmp_path / "m")))
    assert spark.read.parquet(str(tmp_path / "o")).count() > 40


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


SAMPLE = [
    "read_raw_lenient", "write_partitioned_parquet", "parse_count", "extract_posts", "topic_filter", "clean_arrays",
    "clean_and_dedupe", "widening_lookback", "incremental_new_posts", "term_counts", "tfidf_weights", "score_posts",
    "bootstrap_ci_mixed", "sampled_histogram", "stream_score", "posts_to_hourly_signals",
]


@pytest.mark.parametrize("key", SAMPLE)
def test_query_equals_sql(spark, key):
    n, wrong = differences(spark, connect(SF), SF, key)
    assert n > 0 and not wrong


def test_stream_dedupe_leaves_the_folded_text_out_of_the_shuffle(spark, tmp_path):
    landing = str(tmp_path / "landing")
    append_raw(raw(spark, SF).limit(20), landing, "gzip")
    assert {f.name.partition(".")[2] for f in (tmp_path / "landing").glob("part-*")} == {"json.gz"}
    assert read_raw(spark, landing).count() == 20
    arriving = streaming.stream_clean(streaming.stream_raw(spark, landing))
    once = streaming.stream_dedupe(arriving)
    assert once.columns == arriving.columns
    plan = once._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("DeduplicateWithinWatermark") :].splitlines()
    assert "EventTimeWatermark" in below[1] and "content#" in below[2] and "content_norm#" not in below[2]
