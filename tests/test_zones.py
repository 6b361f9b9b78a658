"""Times are read and cut in UTC, whatever the session's time zone."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from murmura.functions import fields
from murmura.operators import buckets, extract, lookback
from murmura.plans.analyze import hourly_signals
from murmura.plans.process import process_posts
from murmura.schemas import RAW_TEXT
from murmura.sources.raw import append_raw, read_raw_counted
from murmura.sources.tables import write_agg, write_partitioned
from murmura.streaming import posts as streaming

TEXTS = [
    "2026-03-08 07:30:00", "2026-03-08T07:30:00.25Z", " 2026-03-08T13:00:00+05:30 ", "2026-03-08", "2026-03", "2026-03-08T",
    "2026-11-01 05:30", "2026-11-01 05:30:00 America/New_York", "10:00:00", "", "x", "20x", None, "1969-12-31 23:59:59.5",
]


@pytest.fixture(params=["Asia/Kolkata", "America/New_York", "UTC"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def seconds(*values):
    return [None if v is None else datetime.fromisoformat(v).replace(tzinfo=timezone.utc).timestamp() for v in values]


def test_texts(spark, zone):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(fields.parse_timestamp(F.col("t")).alias("t"))
    got = [r[0] if r[0] is None else r[0] / 1e6 for r in df.select(F.unix_micros("t")).collect()]
    same = "2026-03-08 07:30:00"
    assert got == seconds(
        same, same + ".25", same, "2026-03-08", None, None, "2026-11-01 05:30", "2026-11-01 10:30", None, None,
        None, None, None, "1969-12-31 23:59:59.5",
    )


def test_days_and_windows(spark, zone):
    instants = ["2026-03-07T23:59:59Z", "2026-03-08T00:00:00Z", "1969-12-31T23:00:00Z"]
    df = spark.createDataFrame([(i,) for i in instants], "t string").select(fields.parse_timestamp(F.col("t")).alias("timestamp"))
    assert [r[0] for r in df.select(fields.utc_date(F.col("timestamp"))).collect()] == ["2026-03-07", "2026-03-08", "1969-12-31"]
    # 24 hours over the night in which New York loses one.
    ends = ["2026-03-09 05:00:00", datetime(2026, 3, 9, 5), datetime(2026, 3, 9, 5, tzinfo=timezone.utc), "2026-03-09T10:30:00+05:30"]
    for as_of in ends:
        start = df.select(F.unix_micros(lookback.window_start(as_of, 24))).first()[0]
        assert start == seconds("2026-03-08 05:00:00")[0] * 1e6
    assert df.select(F.unix_micros(lookback.instant(date(2026, 3, 9)))).first()[0] == seconds("2026-03-09")[0] * 1e6
    tagged = df.withColumn("hashtags", F.array(F.lit("x")))
    assert extract.topic_filter(tagged, ["x"], "2026-03-08 20:00:00", 20).count() == 1
    for width, origin in (("1 day", None), ("7 hours", None), ("7 hours", "2026-03-01 02:00:00")):
        starts = [r[0] for r in buckets.with_bucket(df.limit(2), width, origin).select(F.unix_seconds("bucket_start")).collect()]
        base = seconds(origin or "2026-03-07")[0]
        step = 86400 if width == "1 day" else 7 * 3600
        assert starts == [t - (t - base) % step for t in seconds("2026-03-07 23:59:59", "2026-03-08 00:00:00")]


def raw_posts(spark):
    def post(i):
        moment = datetime(2026, 3, 7, 1) + timedelta(minutes=37 * i)
        words = " ".join(w for k, w in enumerate(["buy", "sell", "rally", "x"]) if i >> k & 1)
        return (str(i), "u", moment.isoformat(" "), f"{words} {i}", "1", "2", str(i % 5), "0", "[]", "[]", "t" if i % 3 else "", "p", f"{i:04d}")

    return spark.createDataFrame([post(i) for i in range(120)], RAW_TEXT)


def seen(df):
    times = [F.unix_micros(c).alias(c) if kind == "timestamp" else F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    return sorted(map(str, df.select(*times).collect()))


def results(spark, folder):
    """Every job and sink once, as whole numbers of microseconds and as files."""
    raw = raw_posts(spark)
    kept = process_posts(raw, "2026-03-10 00:00:00", target=80)
    hours = hourly_signals(kept, min_df=1)
    write_partitioned(kept, f"{folder}/dated")
    write_agg(hours, f"{folder}/agg")
    append_raw(raw, f"{folder}/landing")
    arriving = streaming.stream_clean(streaming.stream_raw(spark, f"{folder}/landing")).withColumn("tweet_signal", F.lit(0.5))
    sink = streaming.flat_sink(streaming.stream_hourly(arriving, "7 hours", "10 minutes", "2026-03-07 01:00:00"), f"{folder}/s", f"{folder}/m")
    sink.trigger(availableNow=True).start().awaitTermination()
    dated = spark.read.parquet(f"{folder}/dated").groupBy(F.col("date").cast("string").alias("date"), "hashtag").count()
    lines = sorted(r.value for r in spark.read.text(f"{folder}/agg").collect())
    return seen(kept), seen(hours), seen(dated), lines, seen(spark.read.parquet(f"{folder}/s"))


def test_jobs_and_sinks(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        there = results(spark, str(tmp_path / "there"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    here = results(spark, str(tmp_path / "here"))
    assert here == there and all(here)
    assert any("2026-03-08 00:00:00.000000+00:00" in line for line in here[3])


def test_counts_of_what_is_skipped(spark, tmp_path):
    lines = [
        '{"tweet_id": "1", "timestamp": "2026-01-01", "likes": "3", "views": "x", "content": "a"}',
        '{"tweet_id": "2", "timestamp": "soon", "replies": "", "retweets": "1.5"}',
        '{"tweet_id": ', "", '{"tweet_id": ""}', '{"likes": "n/a"}', "no json", '{"tweet_id": 3, "timestamp": "2026-01-02", "likes": "1,000"}',
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    posts, counts = read_raw_counted(spark, str(tmp_path))
    assert sorted(r.tweet_id for r in posts.collect()) == ["1", "2", "3"]
    assert counts.get == {
        "lines": 7, "malformed": 2, "without_id": 2, "bad_timestamp": 1,
        "bad_replies": 0, "bad_retweets": 0, "bad_likes": 1, "bad_views": 1,
    }
