"""Text features, scores, buckets and reports against brute force on small inputs."""

import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.functions import text
from murmura.operators import buckets, grams, report, scoring, tfidf

WORDS = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "rare"]


def documents(n=60, seed=3):
    rng = random.Random(seed)
    docs = [" ".join(rng.choices(WORDS[:8], k=rng.randint(0, 12))) for _ in range(n)]
    docs[5] = "rare rare rare"
    return [f"zz {d}".strip() for d in docs]  # zz is in every text


def brute(docs, min_n, max_n, min_df, max_df, k):
    counts = []
    for d in docs:
        t = re.findall(r"\w\w+", d)
        counts.append(Counter(" ".join(t[i : i + n]) for n in range(min_n, max_n + 1) for i in range(len(t) - n + 1)))
    df, cf = Counter(), Counter()
    for c in counts:
        df.update(c.keys())
        cf.update(c)
    kept = sorted((t for t in df if min_df <= df[t] <= max_df * len(docs)), key=lambda t: (-cf[t], t))[:k]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    strengths, weights = [], {}
    for i, c in enumerate(counts):
        w = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        strengths.append(sum(w.values()) / norm if norm else 0.0)
        weights.update({(i, t): v / norm for t, v in w.items()})
    return sorted(kept), df, cf, strengths, weights


def frame(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "tweet_id int, content_norm string").cache()


@pytest.mark.parametrize("k,ngrams", [(5000, (1, 2)), (6, (1, 2)), (12, (1, 3)), (10, (2, 3)), (1, (1, 1))])
def test_tfidf(spark, k, ngrams):
    docs = documents()
    df = frame(spark, docs)
    model = tfidf.fit_tfidf(df, ngram_range=ngrams, max_features=k)
    kept, dfs, cfs, strengths, weights = brute(docs, *ngrams, 2, 0.9, k)
    assert model.terms == kept
    assert model.df == [dfs[t] for t in kept] and model.cf == [cfs[t] for t in kept]
    got = {r.tweet_id: r.tfidf_strength for r in model.strength(df).collect()}
    assert [got[i] for i in range(len(docs))] == pytest.approx(strengths)
    cells = {(r.tweet_id, r.term): r.weight for r in model.weights(df, "tweet_id").collect()}
    assert cells.keys() == weights.keys()
    assert all(cells[c] == pytest.approx(weights[c]) for c in cells)


def test_pruned_counts_equal_full_counts_of_frequent_terms(spark):
    df = tfidf.tokenized(frame(spark, documents(200, seed=9)), "content_norm")
    full = {r.term: (r.df, r.cf) for r in tfidf.corpus_counts(df, 2).collect()}
    words = tfidf.corpus_counts(df, 1).filter("cf >= 120")
    pruned = {r.term: (r.df, r.cf) for r in tfidf.corpus_counts(df, 2, words).collect()}
    assert 0 < len(pruned) < len(full)
    assert all(full[t] == c for t, c in pruned.items())
    assert all(t in pruned for t, (_, cf) in full.items() if cf >= 120)


@pytest.mark.parametrize("n", [2, 3])
def test_known_grams_equal_the_grams_of_known_parts(spark, n):
    docs = [*documents(80, seed=4), "", "aa"]
    df = tfidf.tokenized(frame(spark, docs), "content_norm")
    parts = Counter(" ".join(p) for d in docs for p in zip(*[d.split()[i:] for i in range(n - 1)]))
    heads, tails = sorted(parts)[::2], sorted(parts)[::3]
    got = {r.tweet_id: r["_terms"] for r in tfidf.with_known_grams(df, n, heads, tails).collect()}
    for i, d in enumerate(docs):
        grams = [" ".join(p) for p in zip(*[d.split()[k:] for k in range(n)])]
        known = [g for g in grams if g.rsplit(" ", 1)[0] in set(heads) and g.split(" ", 1)[1] in set(tails)]
        assert got[i] == known
    assert not any(tfidf.with_known_grams(df, n, heads, []).select(F.size("_terms")).distinct().first())


def test_parts_of_ngrams_in_the_row_or_joined(spark, monkeypatch):
    df = tfidf.tokenized(frame(spark, documents(200, seed=9)), "content_norm")
    words = tfidf.corpus_counts(df, 1).filter("cf >= 120")
    inside = tfidf.corpus_counts(df, 2, words)
    assert "Join" not in inside._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tfidf, "SET_TERMS", 0)
    assert sorted(tfidf.corpus_counts(df, 2, words).collect()) == sorted(inside.collect())


def test_scored_columns_are_cut_into_words_once(spark):
    df = scored_posts(spark, documents(40, seed=3)).cache()
    names = ["tweet_id", "engagement", "likes"]
    whole = scoring.score_posts(df, ["aa", "bb"], ["cc"]).select(*names, "tweet_signal", "tfidf_strength")
    narrow = scoring.score_posts(df, ["aa", "bb"], ["cc"], columns=names)
    assert narrow.columns == [*names, "lexicon_score", "tfidf_strength", "engagement_weight", "tweet_signal"]
    assert sorted(narrow.select(*whole.columns).collect()) == sorted(whole.collect())
    words = tfidf.tokenized(df, "content_norm").select("tweet_id", "_tokens")
    model = tfidf.fit_tokens(words)
    plan = model.strength(words)._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1 and model == tfidf.fit_tfidf(df)  # the words are not cut again


ODD = ["", " ", "a", "aa", "aa bb", "bb aa bb aa bb", "\u00e9t\u00e9, \u00c9T\u00c9! x yy_9 \u4f60\u597d \U0001d4b3\U0001d4b4 q", "cc  dd.ee", "aa bb"]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_batches_are_counted_without_a_row_for_each_word(spark, monkeypatch, n):
    docs = [*ODD, *documents(60, seed=5)]
    df = frame(spark, docs)
    cut = [r.t for r in df.orderBy("tweet_id").select(text.tokenize(F.col("content_norm")).alias("t")).collect()]
    lists = [[" ".join(t[i : i + n]) for i in range(len(t) - n + 1)] for t in cut]
    cf = Counter(g for grams in lists for g in grams)
    dfs = Counter(g for grams in lists for g in set(grams))
    for piece in (grams.PIECE, 1, 40):
        monkeypatch.setattr(grams, "PIECE", piece)
        for words in (tfidf.worded(df, "content_norm"), tfidf.tokenized(df, "content_norm")):
            counts = tfidf.corpus_counts(words, n)
            assert {r.term: (r.df, r.cf) for r in counts.collect()} == {g: (dfs[g], cf[g]) for g in cf}
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 2), (1, 3), (2, 3), (3, 3)])
def test_stored_words_score_like_texts(spark, monkeypatch, ngrams):
    df = frame(spark, [*ODD, *documents(80, seed=6)])
    # A low limit leaves terms without their parts in the vocabulary.
    for limits in ({"max_features": 9}, {"max_df": 0.3, "min_df": 1}):
        model = tfidf.fit_tfidf(df, ngram_range=ngrams, **limits)
        monkeypatch.setattr(grams, "PIECE", 50)
        by_row = {r.tweet_id: r.tfidf_strength for r in model.strength(df).collect()}
        stored = model.strength(tfidf.worded(df, "content_norm"))
        assert {r.tweet_id: r.tfidf_strength for r in stored.collect()} == by_row
        assert any(by_row.values())


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 2), (2, 3)])
def test_weights_are_found_batch_by_batch(spark, monkeypatch, ngrams):
    df = frame(spark, [*ODD, *documents(40, seed=8)])
    model = tfidf.fit_tfidf(df, ngram_range=ngrams, max_features=30)
    words = tfidf.worded(df, "content_norm").select("tweet_id", "_words")
    assert tfidf.fit_tfidf(words, ngram_range=ngrams, max_features=30) == model
    index = {i: t for i, t in enumerate(model.terms)}
    counted = model.counts(df, "content_norm").collect()
    want = {(r.tweet_id, index[i]): (int(tf), tf * model.idf[i]) for r in counted for i, tf in zip(r["_index"], r["_tf"])}
    norm = Counter()
    for (key, _), (_, w) in want.items():
        norm[key] += w * w
    for piece, rows in ((grams.PIECE, grams.ROWS), (50, 3)):
        monkeypatch.setattr(grams, "PIECE", piece)
        monkeypatch.setattr(grams, "ROWS", rows)
        for docs in (df, words):
            cells = model.weights(docs, "tweet_id")
            got = {(r.tweet_id, r.term): (r.tf, r.weight) for r in cells.collect()}
            assert got.keys() == want.keys() and cells.count() == len(got) > 20
            assert all(got[c] == (tf, pytest.approx(w / norm[c[0]] ** 0.5)) for c, (tf, w) in want.items())
            plan = cells._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Generate" not in plan


def test_term_counts(spark):
    docs = documents()
    df = tfidf.with_ngrams(frame(spark, docs), "content_norm", 1, 2)
    got = {(r.tweet_id, r.term): r.tf for r in tfidf.term_counts(df, "tweet_id", "_terms").collect()}
    expected = {}
    for i, d in enumerate(docs):
        t = d.split()
        for term, n in Counter(t + [" ".join(p) for p in zip(t, t[1:])]).items():
            expected[i, term] = n
    assert got == expected


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 2), (2, 3)])
def test_terms_of_words_are_counted_batch_by_batch(spark, monkeypatch, ngrams):
    df = frame(spark, [*ODD, *documents(40, seed=9)])
    arrays = tfidf.term_counts(tfidf.with_ngrams(df, "content_norm", *ngrams), "tweet_id", "_terms")
    want = sorted(tuple(r) for r in arrays.collect())
    for piece, rows in ((grams.PIECE, grams.ROWS), (50, 3)):
        monkeypatch.setattr(grams, "PIECE", piece)
        monkeypatch.setattr(grams, "ROWS", rows)
        got = tfidf.term_counts(tfidf.worded(df, "content_norm"), "tweet_id", "_words", ngrams)
        assert got.columns == arrays.columns and sorted(tuple(r) for r in got.collect()) == want
    nothing = tfidf.worded(frame(spark, ["", "a"]), "content_norm")
    assert not tfidf.term_counts(nothing, "tweet_id", "_words", ngrams).collect()


def test_scoring_does_not_shuffle(spark):
    df = frame(spark, documents())
    plan = tfidf.fit_tfidf(df).strength(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_frozen_model_scores_batches_of_words(spark):
    df = scored_posts(spark, documents(60, seed=4))
    model = scoring.fit_signal_model(df)
    by_row = scoring.with_signal(scoring.with_features(df, model.tfidf, ["aa", "bb"], ["cc"]), model.max_strength)
    got = scoring.score_with_model(df, model, ["aa", "bb"], ["cc"])
    assert got.columns == by_row.columns and sorted(got.collect()) == sorted(by_row.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "regexp_extract_all" not in plan and "ArrowEvalPython" in plan
    assert model.max_strength == by_row.agg(F.max("tfidf_strength")).first()[0]


def test_no_vocabulary(spark):
    df = frame(spark, ["aa", "bb"])
    model = tfidf.fit_tfidf(df)
    assert model.terms == [] and {r.tfidf_strength for r in model.strength(df).collect()} == {0.0}
    assert model.weights(df, "tweet_id").count() == 0


def scored_posts(spark, docs):
    rows = [(str(i), d, datetime(2026, 1, 1) + timedelta(minutes=7 * i), i % 9, i % 4, "t") for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "tweet_id string, content_norm string, timestamp timestamp, engagement bigint, likes bigint, query_tag string")


def test_score_posts_and_saved_model(spark, tmp_path):
    docs = documents()
    df = scored_posts(spark, docs).cache()
    got = {r.tweet_id: r for r in scoring.score_posts(df, ["aa", "bb"], ["cc"]).collect()}
    strengths = brute(docs, 1, 2, 2, 0.9, 5000)[3]
    for i, d in enumerate(docs):
        words = set(d.split())
        bull, bear = len(words & {"aa", "bb"}), len(words & {"cc"})
        lex = (bull - bear) / (bull + bear) if bull + bear else 0.0
        signal = 0.7 * lex * math.log1p(i % 9) + 0.3 * lex * strengths[i] / max(strengths)
        assert got[str(i)].tweet_signal == pytest.approx(max(-1, min(1, signal)))
    model = scoring.fit_signal_model(df)
    model.save(spark, str(tmp_path / "m"))
    assert scoring.SignalModel.load(spark, str(tmp_path / "m")) == model
    again = {r.tweet_id: r.tweet_signal for r in scoring.score_with_model(df, model, ["aa", "bb"], ["cc"]).collect()}
    assert again == pytest.approx({k: r.tweet_signal for k, r in got.items()})


def signals(spark, sizes, spread=1.0, seed=1):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for h, n in enumerate(sizes):
        for x in rng.normal(0.1, spread, n):
            rows.append((str(i), datetime(2026, 1, 1, h, i % 60), float(x), 10 + i % 5, i % 3))
            i += 1
    return spark.createDataFrame(rows, "tweet_id string, timestamp timestamp, tweet_signal double, engagement bigint, likes bigint").cache()


def test_bucket_edges(spark):
    times = ["2026-01-01 10:00:00", "2026-01-01 10:59:59.999", "2026-01-01 12:00:00"]
    df = spark.createDataFrame([(t, 0.5, 1, 1) for t in times], "t string, tweet_signal double, engagement bigint, likes bigint")
    got = buckets.bucket_stats(df.withColumn("timestamp", F.col("t").cast("timestamp"))).orderBy("bucket_start").collect()
    assert [(r.bucket_start.hour, r.tweet_count) for r in got] == [(10, 2), (12, 1)]


def test_uneven_buckets_start_with_the_first_day(spark):
    times = ["2026-01-01 05:00:00", "2026-01-01 07:00:00", "2026-01-02 03:30:00", "2026-01-02 05:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("timestamp"))
    got = [str(r.bucket_start) for r in buckets.with_bucket(df, "7 hours").orderBy("timestamp").collect()]
    assert got == ["2026-01-01 00:00:00", "2026-01-01 07:00:00", "2026-01-01 21:00:00", "2026-01-02 04:00:00"]


@pytest.mark.parametrize("method", [buckets.bootstrap_ci, buckets.bootstrap_ci_exact])
def test_bootstrap_intervals(spark, method):
    df = signals(spark, [1, 80, 400, 3000])
    got = method(df).orderBy("bucket_start").collect()
    assert [r.tweet_count for r in got] == [1, 80, 400, 3000]
    assert got[0].ci_low == got[0].ci_high == got[0].signal_mean
    rows = df.select(F.hour("timestamp").alias("h"), "tweet_signal").collect()
    for h in (1, 2, 3):
        x = np.array([r.tweet_signal for r in rows if r.h == h])
        width = 2 * 1.959964 * x.std() / math.sqrt(len(x))
        assert got[h].ci_low < got[h].signal_mean < got[h].ci_high
        assert got[h].ci_high - got[h].ci_low == pytest.approx(width, rel=0.15)


def test_bootstrap_is_repeatable_and_ignores_partitioning(spark):
    df = signals(spark, [30, 50])
    key = lambda d: sorted((r.bucket_start, round(r.ci_low, 12), round(r.ci_high, 12)) for r in d.collect())
    first = key(buckets.bootstrap_ci(df))
    assert first == key(buckets.bootstrap_ci(df.repartition(7)))
    assert first != key(buckets.bootstrap_ci(df, seed=7))
    assert key(buckets.bootstrap_ci_exact(df)) == key(buckets.bootstrap_ci_exact(df.repartition(3)))


def test_constant_values_have_no_spread(spark):
    df = signals(spark, [5, 9], spread=0.0)
    for method in (buckets.bootstrap_ci, buckets.bootstrap_ci_exact):
        for r in method(df).collect():
            assert r.ci_low == pytest.approx(0.1) and r.ci_high == pytest.approx(0.1)


def test_draws_over_cells_are_multinomial(spark):
    """Counts, means and variances of the draws that fall into cells of very different sizes."""
    sizes, replicates = [1, 5, 40, 400, 1554], 3000
    rows = [(datetime(2026, 1, 1), c, m) for c, m in enumerate(sizes)] + [(datetime(2026, 1, 2), 0, 7)]
    cells = spark.createDataFrame(rows, "bucket_start timestamp, cell bigint, m bigint")
    got = buckets.cell_draws(cells, replicates, 42).collect()
    assert sorted((r.cell, r.b, r.k, r.first) for r in got if r.bucket_start.day == 2) == [(0, b, 7, 7 * b) for b in range(replicates)]
    k, first = np.zeros((2, replicates, len(sizes)), np.int64)
    for r in got:
        if r.bucket_start.day == 1:
            k[r.b, r.cell], first[r.b, r.cell] = r.k, r.first
    n, m = sum(sizes), np.array(sizes)
    assert (k.sum(1) == n).all()
    assert (first == k.cumsum(0) - k).all()
    spread = np.sqrt(m * (1 - m / n))
    assert (abs(k.mean(0) - m) < 4 * spread / math.sqrt(replicates)).all()
    assert k.var(0) == pytest.approx(spread**2, rel=0.12)
    assert np.cov(k[:, 3], k[:, 4])[0, 1] == pytest.approx(-m[3] * m[4] / n, rel=0.15)


def test_exact_resampling_of_a_bucket_of_many_cells(spark):
    """Means over 60 cells spread as means of draws from the whole bucket do, skewed values included."""
    x = np.random.default_rng(3).exponential(1.0, 3000)
    rows = [(str(i), datetime(2026, 1, 1), float(v), 1, 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "tweet_id string, timestamp timestamp, tweet_signal double, engagement bigint, likes bigint")
    stats = buckets.bucket_stats(df)
    for cell_posts in (50, 5000):
        held = buckets._held(buckets._values(df, stats, "1 hour", None), stats, 2000, cell_posts)
        assert held.count() == math.ceil(3000 / cell_posts)
        means = np.array([r.mean for r in buckets._multinomial_means(held, stats, 2000, 42).collect()])
        assert len(means) == 2000
        assert means.mean() == pytest.approx(x.mean(), abs=4 * x.std() / math.sqrt(3000 * 2000))
        assert means.std() == pytest.approx(x.std() / math.sqrt(3000), rel=0.07)
    ci = buckets.bootstrap_ci_exact(df, cell_posts=50).first()
    assert ci.ci_high - ci.ci_low == pytest.approx(2 * 1.959964 * x.std() / math.sqrt(3000), rel=0.15)


def test_tasks_follow_the_draws():
    assert buckets.draw_tasks(0, 400, 200) == 1
    assert buckets.draw_tasks(42_000, 400, 200) == 9
    assert buckets.draw_tasks(10**7, 400, 200) == 200
    assert buckets.draw_tasks(10**9, 400, 200) == 2000


def test_features_are_scanned_twice(spark, tmp_path):
    """Once for the statistics, which are stored, and once for the replicates."""
    path = str(tmp_path / "scored")
    signals(spark, [5, 9]).write.parquet(path)
    plan = buckets.bootstrap_ci(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tweet_signal#") and plan.count("Relation [tweet_id") == 1


def test_batch_and_stream_share_an_origin(spark):
    times = ["2026-01-01 05:00:00", "2026-01-01 07:00:00", "2026-01-02 03:30:00", "1969-12-31 23:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("timestamp"))
    got = [str(r.bucket_start) for r in buckets.with_bucket(df, "7 hours", "2026-01-01T02:00:00+00:00").orderBy("timestamp").collect()]
    assert got == ["1969-12-31 19:00:00", "2026-01-01 02:00:00", "2026-01-01 02:00:00", "2026-01-01 23:00:00"]
    late = df.where("timestamp > '2000-01-01'")
    assert str(buckets.bucket_origin(late)) == "2026-01-01 00:00:00+00:00" and buckets.bucket_origin(df.limit(0)) is None
    own, given = (buckets.with_bucket(late, "7 hours", o).collect() for o in (None, buckets.bucket_origin(late)))
    assert sorted(own) == sorted(given)
    with pytest.raises(ValueError):
        buckets.bucket_window("7 hours")


def test_series_and_reports(spark):
    df = signals(spark, [3, 4]).withColumn("query_tag", F.when(F.col("likes") == 0, "a").otherwise(""))
    series = buckets.ci_series(buckets.aggregate_signals(df)).collect()
    assert [r.bucket_start.hour for r in series] == [0, 1]
    values = [r.tweet_signal for r in df.collect()]
    s = report.summary(df).first()
    assert s.tweets == 7 and s.hashtags == ["", "a"] and s.mean_signal == pytest.approx(np.mean(values))
    assert s.bullish_share == pytest.approx(np.mean([v > 0 for v in values]))
    means = [r.mean_signal for r in report.tag_means(df).collect()]
    assert means == sorted(means) and len(means) == 2


@pytest.mark.parametrize("values", [list(range(0, 300, 7)), [5, 5, 5], [1, 2], [0.5, 99.25, 3.0]])
def test_histogram(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = sorted(report.histogram(df, "v").collect())
    counts, edges = np.histogram(values, bins=40)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.bin_low for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.bin_high for r in got] == pytest.approx(edges[1:].tolist())


def test_sample_rows(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("tweet_id"))
    first = {r.tweet_id for r in report.sample_rows(df, 100).collect()}
    assert len(first) == 100 and first == {r.tweet_id for r in report.sample_rows(df.repartition(5), 100).collect()}
    assert first != {r.tweet_id for r in report.sample_rows(df, 100, seed=1).collect()}
    assert report.sample_rows(df, 1000).count() == 500
