"""The same results as SQL over the given tables."""

from __future__ import annotations

from catalogue.inputs import AS_OF, BEARISH, BULLISH, TOPICS
from catalogue.queries import HALF, LOOKBACK, OLD, ORIGIN, TARGET, WIDE_LOOKBACK
from murmura.defaults import BOOTSTRAP_SAMPLES, MAX_DF, MAX_FEATURES, MIN_DF, SEED, TARGET_POSTS

# Fixed values of the draws, written out here so that the SQL doesn't lean on the library it checks: the
# modulus 2^31 - 1, and the cumulative Poisson(1) probabilities on its scale.
PRIME = 2_147_483_647
POISSON_THRESHOLDS = [
    790_015_083, 1_580_030_167, 1_975_037_709, 2_106_706_890, 2_139_624_185, 2_146_207_644,
    2_147_304_887, 2_147_461_637, 2_147_481_230, 2_147_483_407, 2_147_483_625, 2_147_483_645,
]

BASE = """
base AS (
  SELECT e.event_id, e.user_id, e.event_type, e.ts, CAST(floor(e.value) AS BIGINT) AS value, d.text,
         CASE WHEN e.event_type IN ('click', 'purchase')
              THEN ' #' || upper(e.event_type[1]) || e.event_type[2:] || ' #' || d.lang || ' @user_' || e.user_id
              ELSE '' END AS tags,
         e.event_id - CASE WHEN e.event_id % 10 = 9 THEN 1 ELSE 0 END AS number
  FROM events e JOIN documents d ON d.doc_id = (e.event_id * 7) % (SELECT count(*) FROM documents)
)"""

RAW = """
raw AS (
  SELECT CASE value WHEN 14 THEN '' WHEN 15 THEN NULL ELSE CAST(number AS VARCHAR) END AS tweet_id,
         '@@ＵＳＥＲ_' || user_id AS username,
         CASE WHEN value = 13 THEN 'not a time'
              WHEN user_id % 2 = 1 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
         chr(11) || '  ' || text || tags || chr(9) || chr(8195) AS content,
         CASE WHEN value = 16 THEN 'n/a' ELSE CAST(event_id % 7 AS VARCHAR) END AS replies,
         (event_id % 11) || '.7' AS retweets,
         CAST(value AS VARCHAR) AS likes,
         CASE WHEN user_id % 3 <> 0 THEN CAST(value * 10 AS VARCHAR) END AS views,
         CASE WHEN user_id % 5 = 0 THEN '@user_' || user_id
              WHEN user_id % 5 <> 1 THEN '["@@user_' || user_id || '","","@ﬁrm"]' END AS mentions,
         '["#' || upper(event_type[1]) || event_type[2:] || '","","#STRAßE"]' AS hashtags,
         CASE WHEN event_type = 'error' THEN '' ELSE ' ' || upper(event_type) || ' ' END AS query_tag,
         'https://example.org/user_' || user_id || '/status/' || event_id AS permalink,
         lpad(CAST(event_id AS VARCHAR), 12, '0') AS scraped_at,
         ts AS moment, value, user_id, event_id, event_type
  FROM base
)"""

# Control characters that are deleted, and blanks that become one space.
CLEAN = r"""
spaced AS (
  SELECT *, trim(regexp_replace(regexp_replace(content, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'),
                                '[\s\p{Z}\x{85}]+', ' ', 'g')) AS plain
  FROM raw
),
clean AS (
  SELECT tweet_id, 'USER_' || user_id AS username,
         CASE WHEN value <> 13 THEN moment END AS "timestamp",
         plain AS content, replace(lower(plain), 'ß', 'ss') AS content_norm,
         CASE WHEN value = 16 THEN 0 ELSE event_id % 7 END AS replies,
         event_id % 11 AS retweets, value AS likes,
         CASE WHEN user_id % 3 <> 0 THEN value * 10 ELSE 0 END AS views,
         CASE WHEN user_id % 5 = 0 THEN 'user_' || user_id
              WHEN user_id % 5 <> 1 THEN 'user_' || user_id || '|firm' ELSE '' END AS mentions,
         event_type || '|strasse' AS hashtags,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS query_tag,
         permalink, scraped_at, sha1(replace(lower(plain), 'ß', 'ss')) AS content_hash,
         CASE WHEN value = 16 THEN 0 ELSE event_id % 7 END + event_id % 11 + value AS engagement
  FROM spaced
)"""

POSTS = """
valid AS (SELECT * FROM clean WHERE "timestamp" IS NOT NULL AND tweet_id <> ''),
by_id AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY "timestamp" DESC, scraped_at DESC) = 1
),
posts AS (
  SELECT * FROM by_id
  QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY "timestamp" DESC, tweet_id DESC) = 1
)"""

LOOKBACK_CTE = """
chosen AS (
  SELECT coalesce({cases}, TIMESTAMP '0001-01-01 00:00:00') AS start FROM posts
),
kept AS (SELECT * FROM posts WHERE "timestamp" >= (SELECT start FROM chosen))"""

CAPTURE = """
link AS (
  SELECT *, 'https://example.org/user_' || user_id || '/status/' || number AS url,
         lpad(CAST(event_id AS VARCHAR), 12, '0') AS scraped_at
  FROM base
),
capture AS (
  SELECT CASE WHEN value = 20 THEN NULL WHEN event_type = 'signup' THEN url || '//'
              WHEN event_type = 'error' THEN 'https://example.org/about' ELSE url END AS permalink,
         CASE WHEN value <> 21 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS "datetime",
         CASE user_id % 4 WHEN 0 THEN 'Name' || chr(10) || '@user_' || user_id || chr(10) || '1h'
              WHEN 1 THEN '@@user_' || user_id
              WHEN 2 THEN 'Name ' || user_id || chr(10) || '2h' END AS user_block,
         text || tags AS content,
         value || ',001 replies' AS reply_label,
         value || '.25K' AS retweet_label,
         CASE value % 3 WHEN 0 THEN 'Likes' WHEN 1 THEN value || ' minutes' ELSE value || '.2.3' END AS like_label,
         CASE WHEN value % 2 = 0 THEN value || 'm views' ELSE '' END AS views_label,
         scraped_at, ts, number, value
  FROM link
),
labelled AS (
  SELECT *, list_transform(
    [reply_label, retweet_label, like_label, views_label],
    lambda x: coalesce(CAST(try_cast(regexp_extract(replace(x, ',', ''), '([0-9.]+)', 1) AS DOUBLE)
      * CASE lower(regexp_extract(replace(x, ',', ''), '[0-9.]+\\s*([KkMm])', 1))
             WHEN 'k' THEN 1000 WHEN 'm' THEN 1000000 ELSE 1 END AS DOUBLE), 0)) AS counts
  FROM capture
),
fields AS (
  SELECT *, CASE WHEN list_any_value(list_filter(string_split(user_block, chr(10)), lambda x: x[1] = '@')) IS NOT NULL
                 THEN list_filter(string_split(user_block, chr(10)), lambda x: x[1] = '@')[1][2:]
                 ELSE coalesce(string_split(user_block, chr(10))[1], '') END AS username,
         list_transform(counts, lambda x: CAST(trunc(x) AS BIGINT)) AS n,
         regexp_extract_all(content, '@([A-Za-z0-9_]{1,15})', 1) AS mentions,
         list_transform(regexp_extract_all(content, '#([\\p{L}\\p{N}_]+)', 1), lambda x: lower(x)) AS hashtags
  FROM labelled
),
extracted AS (
  SELECT *, CAST(number AS VARCHAR) AS tweet_id FROM fields
  WHERE "datetime" IS NOT NULL AND permalink IS NOT NULL AND contains(permalink, '/status/')
)""".replace("\\\\", "\\")

TERMS = r"""
tokens AS (SELECT tweet_id, regexp_extract_all(lower(content_norm), '[\p{L}\p{N}_]{2,}') AS t FROM docs),
grams AS (
  SELECT tweet_id, t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS g FROM tokens
),
term_counts AS (
  SELECT tweet_id, term, count(*) AS tf
  FROM (SELECT tweet_id, unnest(t) AS term FROM grams UNION ALL SELECT tweet_id, unnest(g) FROM grams)
  GROUP BY tweet_id, term
)"""

VOCABULARY = f"""
vocabulary AS (
  SELECT term, df, cf, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM term_counts GROUP BY term),
       (SELECT count(*) AS n FROM docs)
  WHERE df >= {MIN_DF} AND df <= {MAX_DF} * n
  ORDER BY cf DESC, term LIMIT {MAX_FEATURES}
),
cells AS (SELECT tweet_id, term, tf, tf * idf AS w FROM term_counts JOIN vocabulary USING (term)),
strengths AS (SELECT tweet_id, sum(w) / sqrt(sum(w * w)) AS s, sqrt(sum(w * w)) AS norm FROM cells GROUP BY tweet_id)"""


def _lexicon(text: str) -> str:
    def hits(words: list[str]) -> str:
        return " + ".join(f"CAST(list_contains(string_split({text}, ' '), '{w}') AS INT)" for w in words)

    bull, bear = hits(BULLISH), hits(BEARISH)
    return f"coalesce((({bull}) - ({bear})) / nullif(CAST(({bull}) + ({bear}) AS DOUBLE), 0), 0.0)"


SCORED = f"""
featured AS (
  SELECT d.*, coalesce(s.s, 0.0) AS tfidf_strength, ln(1 + engagement) AS engagement_weight,
         {_lexicon('content_norm')} AS lexicon_score
  FROM docs d LEFT JOIN strengths s USING (tweet_id)
),
scored AS (
  SELECT *, greatest(-1.0, least(1.0, 0.7 * lexicon_score * engagement_weight + 0.3 * coalesce(
    lexicon_score * tfidf_strength / nullif((SELECT max(tfidf_strength) FROM featured), 0), 0.0))) AS tweet_signal
  FROM featured
)"""

DOCS = "docs AS (SELECT * FROM posts)"


def _draw(offset: str, slope: str, number: str) -> str:
    x = f"(({offset} + {slope} * {number}) % {PRIME})"
    square = f"({x} * {x} % {PRIME})"
    return f"({square} * {square} % {PRIME} * {x} % {PRIME})"


def _seeds(key: str) -> str:
    digest = f"md5({key} || ':{SEED}')"
    return (
        f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % {PRIME} AS o, "
        f"CAST('0x' || substr({digest}, 9, 8) AS BIGINT) % {PRIME - 1} + 1 AS s"
    )


def _bucketed(width: str) -> str:
    return f"""
bucketed AS (
  SELECT date_trunc('{width}', "timestamp") AS bucket_start, * FROM scored
),
stats AS (
  SELECT bucket_start, count(*) AS tweet_count, avg(tweet_signal) AS signal_mean,
         avg(engagement) AS mean_engagement, avg(likes) AS mean_likes
  FROM bucketed GROUP BY bucket_start
)"""


def _poisson(where: str, replicates: int) -> str:
    weight = " + ".join(f"CAST(u >= {t} AS INT)" for t in POISSON_THRESHOLDS)
    return f"""
poisson_draws AS (
  SELECT bucket_start, b, x, {_draw('o', 's', 'b')} AS u
  FROM (SELECT bucket_start, tweet_signal AS x, {_seeds('tweet_id')}
        FROM bucketed JOIN stats USING (bucket_start) WHERE {where}),
       (SELECT unnest(range(1, {replicates} + 1)) AS b)
),
poisson_means AS (
  SELECT bucket_start, sum(w * x) / nullif(sum(w), 0) AS mean
  FROM (SELECT bucket_start, b, x, {weight} AS w FROM poisson_draws) GROUP BY bucket_start, b
)"""


def _multinomial(where: str, replicates: int) -> str:
    return f"""
held AS (
  SELECT bucket_start, list(tweet_signal ORDER BY tweet_id) AS xs, count(*) AS size,
         {_seeds("CAST(CAST(epoch(bucket_start) AS BIGINT) AS VARCHAR)")}
  FROM bucketed JOIN stats USING (bucket_start) WHERE {where} GROUP BY bucket_start
),
numbered AS (SELECT *, unnest(range(0, size * {replicates})) AS n FROM held),
multinomial_means AS (
  SELECT bucket_start, avg(xs[CAST({_draw('o', 's', 'n')} % size AS BIGINT) + 1]) AS mean
  FROM numbered GROUP BY bucket_start, n // size
)"""


def _interval(*sources: str) -> str:
    union = " UNION ALL ".join(f"SELECT bucket_start, mean FROM {s}" for s in sources)
    return f"""
quantiles AS (
  SELECT bucket_start, quantile_cont(mean, [0.025, 0.975]) AS q FROM ({union}) GROUP BY bucket_start
),
aggregated AS (
  SELECT bucket_start, tweet_count, signal_mean,
         CASE WHEN tweet_count = 1 THEN signal_mean ELSE q[1] END AS ci_low,
         CASE WHEN tweet_count = 1 THEN signal_mean ELSE q[2] END AS ci_high,
         mean_engagement, mean_likes
  FROM stats LEFT JOIN quantiles USING (bucket_start)
)"""


TIME = """strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp\""""
HOUR = "strftime(bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start"

CLEAN_VIEW = f"""
SELECT tweet_id, username, {TIME}, md5(content) AS content, md5(content_norm) AS content_norm, replies,
       retweets, likes, views, mentions, hashtags, query_tag, permalink, scraped_at, content_hash, engagement
FROM """
RAW_VIEW = """
SELECT tweet_id, username, "timestamp", md5(content) AS content, replies, retweets, likes, views, mentions,
       hashtags, query_tag, permalink, scraped_at
FROM """
STATS_VIEW = f"""
SELECT {HOUR}, tweet_count, round(signal_mean, 6) AS signal_mean,
       round(mean_engagement, 6) AS mean_engagement, round(mean_likes, 6) AS mean_likes
FROM """
AGG_VIEW = f"""
SELECT {HOUR}, tweet_count, round(signal_mean, 6) AS signal_mean, round(ci_low, 6) AS ci_low,
       round(ci_high, 6) AS ci_high, round(mean_engagement, 6) AS mean_engagement,
       round(mean_likes, 6) AS mean_likes
FROM """
SCORED_VIEW = f"""
SELECT tweet_id, {TIME}, query_tag, engagement, likes, md5(content_norm) AS content_norm,
       round(lexicon_score, 6) AS lexicon_score, round(tfidf_strength, 6) AS tfidf_strength,
       round(engagement_weight, 6) AS engagement_weight, round(tweet_signal, 6) AS tweet_signal
FROM """
SUMMARY = """
SELECT count(*) AS tweets, round(avg(tweet_signal), 6) AS mean_signal,
       round(avg(CAST(tweet_signal > 0 AS INT)), 6) AS bullish_share,
       round(avg(CAST(tweet_signal < 0 AS INT)), 6) AS bearish_share,
       array_to_string(list_sort(list(DISTINCT query_tag)), '|') AS hashtags
FROM scored"""
PARTITIONS = """
SELECT strftime("timestamp", '%Y-%m-%d') AS date, CASE WHEN query_tag = '' THEN 'unknown' ELSE query_tag END AS hashtag,
       count(*) AS posts, count(DISTINCT query_tag) AS tags, CAST(sum(engagement) AS BIGINT) AS engagement
FROM {source} GROUP BY ALL"""


def _histogram(source: str) -> str:
    return f"""
, edges AS (
  SELECT min(engagement) - CASE WHEN min(engagement) = max(engagement) THEN 0.5 ELSE 0 END::DOUBLE AS low,
         max(engagement) + CASE WHEN min(engagement) = max(engagement) THEN 0.5 ELSE 0 END::DOUBLE AS high
  FROM {source}
),
counted AS (
  SELECT least(CAST(floor((engagement - low) * 40 / (high - low)) AS BIGINT), 39) AS bin, count(*) AS n
  FROM {source}, edges GROUP BY 1
)
SELECT bin, round(low + bin * (high - low) / 40, 6) AS bin_low, round(low + (bin + 1) * (high - low) / 40, 6) AS bin_high,
       coalesce(n, 0) AS count
FROM (SELECT unnest(range(0, 40)) AS bin) LEFT JOIN counted USING (bin) CROSS JOIN edges"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _lookback(hours: tuple[int, ...], target: int) -> str:
    cases = ", ".join(
        f"CASE WHEN count(*) FILTER (\"timestamp\" >= TIMESTAMP '{AS_OF}' - INTERVAL {h} HOUR) >= {target} "
        f"THEN TIMESTAMP '{AS_OF}' - INTERVAL {h} HOUR END"
        for h in hours
    )
    return LOOKBACK_CTE.format(cases=cases)


def oracle() -> dict[str, str]:
    raw = _with(BASE, RAW)
    capture = _with(BASE, CAPTURE)
    clean = _with(BASE, RAW, CLEAN)
    posts = _with(BASE, RAW, CLEAN, POSTS)
    terms = _with(BASE, RAW, CLEAN, POSTS, DOCS, TERMS)
    vocabulary = terms + "," + VOCABULARY
    scored = vocabulary + "," + SCORED
    b = BOOTSTRAP_SAMPLES
    hourly = scored + "," + ",".join([_bucketed("hour"), _poisson("true", b), _interval("poisson_means")])
    topics = "[" + ", ".join(f"'{t}'" for t in TOPICS) + "]"
    valid_ids = "(SELECT * FROM raw WHERE tweet_id <> '') QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY scraped_at) = 1"
    stream_scored = (
        f"stream_posts AS (SELECT *, {_lexicon('content_norm')} * ln(1 + engagement) AS tweet_signal FROM valid)"
    )
    # The model is fitted on the deduplicated posts and applied to every valid post.
    every_term = TERMS.replace("tokens AS", "all_tokens AS").replace("grams AS", "all_grams AS").replace(
        "FROM tokens", "FROM all_tokens"
    ).replace("FROM grams", "FROM all_grams").replace("term_counts AS", "all_terms AS").replace(
        "FROM docs", "FROM texts"
    ).replace("tweet_id", "text_id").replace(
        "unnest(g) FROM all_grams)", "unnest(g) FROM all_grams) SEMI JOIN vocabulary USING (term)"
    )
    texts = """texts AS (SELECT content_norm, row_number() OVER () AS text_id
                        FROM (SELECT DISTINCT content_norm FROM valid))"""

    rated = f"""all_strengths AS (
               SELECT text_id, sum(tf * idf) / sqrt(sum(tf * idf * tf * idf)) AS s
               FROM all_terms JOIN vocabulary USING (term) GROUP BY text_id),
             rated AS (SELECT v.*, coalesce(s, 0.0) AS strength, {_lexicon('content_norm')} AS lex
                       FROM valid v JOIN texts USING (content_norm) LEFT JOIN all_strengths USING (text_id)),
             blended AS (SELECT *, greatest(-1.0, least(1.0, 0.7 * lex * ln(1 + engagement) + 0.3 * lex * strength
                       / (SELECT max(s) FROM strengths))) AS tweet_signal FROM rated)"""
    seven = f"""SELECT strftime(bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start, count(*) AS tweet_count,
                    round(avg(tweet_signal), 6) AS signal_mean, round(avg(engagement), 6) AS mean_engagement,
                    round(avg(likes), 6) AS mean_likes
             FROM (SELECT *, time_bucket(INTERVAL 7 HOUR, "timestamp", TIMESTAMP '{ORIGIN}') AS bucket_start FROM stream_posts)
             GROUP BY ALL"""
    resumed = """, ids AS (SELECT tweet_id, scraped_at, md5(content) AS content FROM extracted WHERE tweet_id <> ''),
             before AS (SELECT * FROM (SELECT * FROM ids WHERE scraped_at LIKE '%3'
                          QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY scraped_at) = 1)
                        ORDER BY scraped_at, tweet_id LIMIT 300),
             added AS (SELECT * FROM (SELECT * FROM ids WHERE tweet_id NOT IN (SELECT tweet_id FROM before)
                         QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY scraped_at) = 1)
                       ORDER BY scraped_at, tweet_id LIMIT (SELECT 800 - count(*) FROM before))
             SELECT * FROM before UNION ALL SELECT * FROM added"""

    return {
        "read_raw_jsonl": raw + RAW_VIEW + "raw",
        "read_raw_lenient": raw + RAW_VIEW + "raw WHERE likes <> '17' AND tweet_id <> ''",
        "bad_row_counts": raw
        + """SELECT count(*) AS lines, count(*) FILTER (value = 17) AS malformed,
                    count(*) FILTER (value IN (14, 15)) AS without_id, count(*) FILTER (value = 13) AS bad_timestamp,
                    count(*) FILTER (value = 16) AS bad_replies, CAST(0 AS BIGINT) AS bad_retweets,
                    CAST(0 AS BIGINT) AS bad_likes, CAST(0 AS BIGINT) AS bad_views FROM raw""",
        "append_raw_jsonl": raw + RAW_VIEW + "raw",
        "write_flat_parquet": posts + CLEAN_VIEW + "posts",
        "write_partitioned_parquet": posts + PARTITIONS.format(source="posts"),
        "sample_head": posts + CLEAN_VIEW + 'posts ORDER BY posts."timestamp", tweet_id LIMIT 100',
        "write_sample_files": posts
        + 'SELECT tweet_id, md5(content) AS content, likes, hashtags FROM posts ORDER BY "timestamp", tweet_id LIMIT 100',
        "write_agg_csv": hourly + AGG_VIEW + "aggregated",
        "write_scored_parquet": scored + SCORED_VIEW + "scored",
        "write_vocabulary": vocabulary + "SELECT term FROM vocabulary",
        "write_summary": scored + SUMMARY,
        "extract_post_id": capture + "SELECT scraped_at, tweet_id FROM extracted",
        "extract_username": capture + "SELECT scraped_at, username FROM fields",
        "parse_count": capture
        + """SELECT scraped_at, n[1] AS reply_label, n[2] AS retweet_label, n[3] AS like_label, n[4] AS views_label,
                    CASE WHEN value % 3 = 1 THEN value ELSE 0 END AS strict_likes FROM fields""",
        "extract_mentions": capture + "SELECT scraped_at, array_to_string(mentions, '|') AS mentions FROM fields",
        "extract_hashtags": capture + "SELECT scraped_at, array_to_string(hashtags, '|') AS hashtags FROM fields",
        "extract_posts": capture
        + """SELECT tweet_id, username, "datetime" AS "timestamp", md5(content) AS content, n[1] AS replies, n[2] AS retweets,
                    n[3] AS likes, n[4] AS views, array_to_string(mentions, '|') AS mentions,
                    array_to_string(hashtags, '|') AS hashtags, 'mixed' AS query_tag, permalink, scraped_at FROM extracted""",
        "topic_filter": capture
        + f"""SELECT scraped_at, tweet_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", array_to_string(hashtags, '|') AS hashtags
              FROM extracted WHERE list_has_any(hashtags, {topics})
              AND ts >= date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL 180 HOUR)""",
        "assign_topic": capture
        + f"""SELECT scraped_at, tweet_id, CASE len(list_intersect({topics}, hashtags)) WHEN 0 THEN ''
              WHEN 1 THEN list_intersect({topics}, hashtags)[1] ELSE 'mixed' END AS query_tag FROM extracted""",
        "normalize_text": clean + "SELECT scraped_at, md5(content) AS content, '@@' || username AS username FROM clean",
        "casefold": raw + "SELECT scraped_at, md5(replace(lower(content), 'ß', 'ss')) AS folded FROM raw",
        "clean_arrays": clean + "SELECT scraped_at, mentions, hashtags FROM clean",
        "int_or_zero": clean + "SELECT scraped_at, replies, retweets, likes, views FROM clean",
        "content_hash": clean + "SELECT scraped_at, content_hash FROM clean",
        "parse_timestamp": clean + f"SELECT scraped_at, {TIME} FROM clean",
        "date_partition": clean
        + """SELECT scraped_at, strftime("timestamp", '%Y-%m-%d') AS date,
                    CASE WHEN query_tag = '' THEN 'unknown' ELSE query_tag END AS hashtag FROM clean""",
        "clean_rows": clean + CLEAN_VIEW + "clean",
        "lexicon_score": clean + f"SELECT scraped_at, round({_lexicon('content_norm')}, 6) AS lexicon_score FROM clean",
        "engagement_weight": clean + "SELECT scraped_at, round(ln(1 + engagement), 6) AS engagement_weight FROM clean",
        "tweet_signal": scored + "SELECT tweet_id, round(tweet_signal, 6) AS tweet_signal FROM scored",
        "drop_invalid": posts + f"SELECT scraped_at, tweet_id, {TIME} FROM valid",
        "widening_lookback": posts + "," + _lookback(LOOKBACK, TARGET) + f"SELECT tweet_id, {TIME} FROM kept",
        "widening_lookback_fallback": posts + f"SELECT tweet_id, {TIME} FROM posts",
        "fixed_lookback": posts
        + f"SELECT tweet_id, {TIME} FROM posts WHERE posts.\"timestamp\" >= TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR",
        "take_target": raw
        + f"SELECT tweet_id, scraped_at, md5(content) AS content FROM (SELECT * FROM {valid_ids}) ORDER BY scraped_at, tweet_id LIMIT 500",
        "latest_n": posts + f'SELECT tweet_id, {TIME} FROM posts ORDER BY posts."timestamp" DESC, tweet_id LIMIT 250',
        "dedupe_by_id": posts + CLEAN_VIEW + "by_id",
        "dedupe_by_content": posts + CLEAN_VIEW + "posts",
        "clean_and_dedupe": posts + CLEAN_VIEW + "posts",
        "incremental_new_posts": raw
        + f"""SELECT tweet_id, scraped_at, md5(content) AS content FROM (SELECT * FROM {valid_ids})
              WHERE tweet_id NOT IN (SELECT tweet_id FROM raw WHERE query_tag = ' CLICK ' AND tweet_id IS NOT NULL)""",
        "ingest_resumed": capture
        + resumed,
        "stream_dedupe_resumed": capture + resumed,
        "tokenize": terms + "SELECT tweet_id, md5(array_to_string(t, ' ')) AS tokens FROM tokens",
        "ngrams": terms
        + "SELECT tweet_id, len(t) + len(g) AS n, md5(array_to_string(list_concat(t, g), '|')) AS ngrams FROM grams",
        "term_counts": terms
        + """SELECT tweet_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS occurrences, max(tf) AS max_tf,
                    CAST(sum(tf * length(term)) AS BIGINT) AS letters, CAST(sum(tf * unicode(term)) AS BIGINT) AS initials
             FROM term_counts GROUP BY tweet_id""",
        "vocabulary": vocabulary + "SELECT term, df, cf, round(idf, 6) AS idf FROM vocabulary",
        "tfidf_weights": vocabulary
        + """SELECT term, count(*) AS posts, CAST(sum(tf) AS BIGINT) AS tf, round(sum(w / norm), 6) AS weight,
                    round(max(w / norm), 6) AS max_weight FROM cells JOIN strengths USING (tweet_id) GROUP BY term""",
        "tfidf_strength": scored + "SELECT tweet_id, round(tfidf_strength, 6) AS tfidf_strength FROM featured",
        "score_posts": scored + SCORED_VIEW + "scored",
        "bucket_stats": scored + "," + _bucketed("hour") + STATS_VIEW + "stats",
        "bucket_stats_7h": scored
        + f""" SELECT strftime(bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start, count(*) AS tweet_count,
                    round(avg(tweet_signal), 6) AS signal_mean, round(avg(engagement), 6) AS mean_engagement,
                    round(avg(likes), 6) AS mean_likes
             FROM (SELECT *, time_bucket(INTERVAL 7 HOUR, "timestamp",
                     (SELECT CAST(date_trunc('day', min("timestamp")) AS TIMESTAMP) FROM scored)) AS bucket_start FROM scored)
             GROUP BY ALL""",
        "hourly_signals": hourly + AGG_VIEW + "aggregated",
        "bootstrap_ci": scored
        + "," + ",".join([_bucketed("day"), _poisson("true", b), _interval("poisson_means")])
        + AGG_VIEW + "aggregated",
        "bootstrap_ci_exact": scored
        + "," + ",".join([_bucketed("day"), _multinomial("true", b), _interval("multinomial_means")])
        + AGG_VIEW + "aggregated",
        "bootstrap_ci_mixed": scored
        + "," + ",".join([_bucketed("hour"), _multinomial("true", b), _interval("multinomial_means")])
        + AGG_VIEW + "aggregated",
        "bootstrap_cells": scored + "," + _bucketed("day")
        + f""" SELECT {HOUR}, tweet_count, round(signal_mean, 6) AS signal_mean, tweet_count * {b} AS draws,
                      true AS covered FROM stats""",
        "ci_series": scored
        + "," + ",".join([_bucketed("hour"), _poisson("true", 100), _interval("poisson_means")])
        + f"""SELECT {HOUR}, round(signal_mean, 6) AS signal_mean, round(ci_low, 6) AS ci_low,
                     round(ci_high, 6) AS ci_high FROM aggregated""",
        "summary": scored + SUMMARY,
        "tag_means": scored
        + "SELECT query_tag, round(avg(tweet_signal), 6) AS mean_signal FROM scored GROUP BY query_tag",
        "engagement_histogram": posts + _histogram("posts"),
        "sampled_histogram": posts
        + f", sampled AS (SELECT * FROM posts ORDER BY md5(tweet_id || ':{SEED}'), tweet_id LIMIT 1500)"
        + _histogram("sampled"),
        "sample_rows": posts
        + f"SELECT tweet_id, engagement FROM posts ORDER BY md5(tweet_id || ':{SEED}'), tweet_id LIMIT 1500",
        "posts_to_hourly_signals": _with(
            BASE, RAW, CLEAN, POSTS, _lookback(WIDE_LOOKBACK, TARGET_POSTS), "docs AS (SELECT * FROM kept)",
            TERMS, VOCABULARY, SCORED, _bucketed("hour"), _poisson("true", b), _interval("poisson_means"),
        )
        + AGG_VIEW + "aggregated",
        "stream_raw": raw + RAW_VIEW + "raw",
        "stream_dedupe": posts + "SELECT DISTINCT tweet_id FROM valid",
        "stream_hourly": posts + "," + stream_scored + "," + _bucketed("hour").replace("FROM scored", "FROM stream_posts")
        + STATS_VIEW + "stats",
        "stream_score": vocabulary + "," + texts + "," + every_term
        + "," + rated
        + """ SELECT scraped_at, round(strength, 6) AS tfidf_strength, round(tweet_signal, 6) AS tweet_signal FROM blended""",
        "stream_hourly_append": vocabulary + "," + texts + "," + every_term + "," + rated
        + f""", sorted_out AS (
               SELECT *, date_trunc('hour', "timestamp") AS bucket_start,
                      "timestamp" < TIMESTAMP '{OLD}' AND likes % 10 = 3 AS is_late FROM blended)
             SELECT {HOUR}, count(*) FILTER (NOT is_late) AS tweet_count,
                    round(avg(tweet_signal) FILTER (NOT is_late), 6) AS signal_mean,
                    round(avg(engagement) FILTER (NOT is_late), 6) AS mean_engagement,
                    round(avg(likes) FILTER (NOT is_late), 6) AS mean_likes, count(*) FILTER (is_late) AS late
             FROM sorted_out GROUP BY sorted_out.bucket_start""",
        "stream_hourly_7h": posts + "," + stream_scored + seven,
        "bucket_stats_7h_origin": posts + "," + stream_scored + seven,
        "stream_latest": posts + CLEAN_VIEW + "posts",
        "stream_partitioned_batches": posts + PARTITIONS.format(source="valid"),
        "stream_partitioned_sink": posts + PARTITIONS.format(source="valid"),
    }
