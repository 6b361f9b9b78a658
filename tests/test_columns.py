"""Edge rows of the column functions; texts are checked against Python's own Unicode rules."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from murmura.functions import fields, resample, signal, text
from murmura.operators import tfidf


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    return [r.v for r in df.select("i", build(F.col("c")).alias("v")).orderBy("i").collect()]


def python_normalize(t):
    value = unicodedata.normalize("NFKC", t or "")
    value = re.sub(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "", value)
    return re.sub(r"\s+", " ", value).strip()


TEXTS = [None, "", "a\x0bb", "a\tb", "ﬁ", "a b", " x ", "a\r\n\n b", "\x1ca\x85b c", "Ａ①½", "é", "शेयर बाज़ार", "a\xa0\xa0b", "😀 ‍ x", " a"]


def test_normalize_text(spark):
    assert column(spark, TEXTS, text.normalize_text) == [python_normalize(t) for t in TEXTS]


def test_unicode_rules_for_every_assigned_character(spark):
    cps = [i for i in range(0x20000) if not 0xD800 <= i <= 0xDFFF and unicodedata.category(chr(i)) != "Cn"]
    values = [f" x{chr(c)}{chr(c)}y {chr(c)}" for c in cps]
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string").select(
        "i", text.normalize_text(F.col("c")).alias("n"), text.casefold(F.col("c")).alias("f"), text.tokenize(F.col("c")).alias("t")
    )
    word = re.compile(r"(?u)\b\w\w+\b")
    wrong_tokens = 0
    for r in df.collect():
        assert r.n == python_normalize(values[r.i]), hex(cps[r.i])
        assert r.f == values[r.i].casefold(), hex(cps[r.i])
        wrong_tokens += list(r.t) != word.findall(values[r.i].lower())
    assert wrong_tokens < 800  # letters and digits newer than the character table of Java 17


def test_casefold(spark):
    assert column(spark, [None, "Straße", "ΣΑΣ", "İ", "ABC"], text.casefold) == [None, "strasse", "σασ", "i̇", "abc"]


def test_clean_array(spark):
    values = [None, "", "x", '["", "@@Ab", null]', '[" "]', "[broken", '["a", "b"]']
    got = column(spark, values, lambda c: text.clean_array(text.text_items(c), "@"))
    assert got == [[], [], ["x"], ["Ab"], [""], ["[broken"], ["a", "b"]]
    assert column(spark, ['["#NIFTY50", "##Straße"]'], lambda c: text.clean_array(text.text_items(c), "#", folded=True)) == [["nifty50", "strasse"]]


@pytest.mark.parametrize("strict", [False, True])
def test_parse_count(spark, strict):
    cases = {
        None: 0, "": 0, "Likes": 0, "1,234": 1234, "1.2K": 1200, "3m": 3_000_000, "1.001k": 1000, "12 minutes": 12 if strict else 12_000_000,
        "1.2.3": 0, ".": 0, "5 Likes": 5, "१२ पसंद": 12, "0.5k": 500, "7 K replies": 7000,
    }
    assert column(spark, list(cases), lambda c: fields.parse_count(c, strict)) == list(cases.values())


def test_post_fields(spark):
    links = ["https://e.org/u/status/12//", "https://e.org/u/status/7", "https://e.org/u", None]
    assert column(spark, links, lambda c: F.when(fields.is_post_link(c), fields.post_id(c))) == ["12", "7", None, None]
    blocks = ["Name\n@abc\n1h", "Name", None, "@@x", "", "A\nB\n@c\n@d"]
    assert column(spark, blocks, fields.username) == ["abc", "Name", "", "@x", "", "c"]
    assert column(spark, ["a@b.com @" + "x" * 20, "none"], fields.mentions) == [["b", "x" * 15], []]
    assert column(spark, ["#शेयर #NIFTY50 #a_b-c"], fields.hashtags) == [["श", "nifty50", "a_b"]]
    assert column(spark, ["#शेयर"], lambda c: fields.hashtags(c, with_marks=True)) == [["शेयर"]]


def test_numbers_and_times(spark):
    assert column(spark, [None, "", "12", "12.9", "-3.7", "x", "1e3", "NaN"], fields.int_or_zero) == [0, 0, 12, 12, -3, 0, 1000, 0]
    assert column(spark, [None, "", "3", "x"], fields.is_bad_number) == [False, False, False, True]
    times = ["2026-08-03T06:00:00+05:30", "2026-08-03 06:00:00", "2026-08-03T06:00:00.000Z", "x", None]
    got = column(spark, times, lambda c: fields.parse_timestamp(c).cast("string"))
    assert got == ["2026-08-03 00:30:00", "2026-08-03 06:00:00", "2026-08-03 06:00:00", None, None]


def test_lexicon_score(spark):
    score = lambda c: signal.lexicon_score(c, ["buy", "long"], ["sell", "short", "fall"])
    got = column(spark, ["buy buy sell", "buy", "buy,", "long short short fall", "", None], score)
    assert got == pytest.approx([0.0, 1.0, 0.0, -1 / 3, 0.0, 0.0])


def test_blend_signal(spark):
    rows = [(1.0, 4, 1.0, 2.0), (0.0, 100, 1.0, 2.0), (1.0, 0, 1.0, 2.0), (-0.5, 1, 0.0, 0.0), (-1.0, 50, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "lex double, eng bigint, s double, m double").select(
        signal.blend_signal(F.col("lex"), signal.engagement_weight(F.col("eng")), F.col("s"), F.col("m")).alias("v")
    )
    assert [r.v for r in df.collect()] == pytest.approx([1.0, 0.0, 0.15, -0.35 * 0.6931471805599453, -1.0])


def test_tokens_and_ngrams(spark):
    assert column(spark, ["a bc d_e f, gh1", "x", None], text.tokenize) == [["bc", "d_e", "gh1"], [], []]
    df = spark.createDataFrame([("aa bb cc",), ("aa",), ("",), (None,)], "c string")
    grams = [r["_terms"] for r in tfidf.with_ngrams(df, "c", 1, 3).collect()]
    assert grams == [["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["aa"], [], []]


def test_resampling_weights_are_poisson(spark):
    o, s = resample.seeds(F.col("id").cast("string"), 42)
    drawn = (
        spark.range(4000)
        .select("id", o.alias("o"), s.alias("s"), F.explode(F.sequence(F.lit(1), F.lit(50))).alias("b"))
        .withColumn("u", resample.draw(F.col("o"), F.col("s"), F.col("b")))
        .withColumn("w", resample.poisson_weight(F.col("u")))
    )
    r = drawn.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v"), F.avg((F.col("w") == 0).cast("double")).alias("z"), F.min("u").alias("lo"), F.max("u").alias("hi")).first()
    assert r.m == pytest.approx(1.0, abs=0.01) and r.v == pytest.approx(1.0, abs=0.02)
    assert r.z == pytest.approx(0.367879, abs=0.005)
    assert 0 <= r.lo and r.hi < resample.PRIME
    per_replicate = drawn.groupBy("b").agg(F.sum("w").alias("n")).agg(F.var_samp("n").alias("v")).first().v
    assert 2400 < per_replicate < 6200  # variance of the sum of 4000 independent weights


def test_words_of_plain_and_other_texts(spark):
    """Texts of ASCII characters alone take a shorter way, to the words of every other text."""
    every = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    texts = ["", "a, b;c_d--e  f\n9.5", "\u212a, K", "caf\u00e9, \u2014 th\u00e9", *(f"x{c}{c}y {c}," for c in map(chr, range(128)))]
    texts += ["y".join(every[i : i + 5000]) for i in range(0, len(every), 5000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "c string")
    lowered = F.lower(F.coalesce("c", F.lit("")))
    plain = F.octet_length("c") == F.char_length("c")
    rows = df.select(
        text.words(F.col("c")).alias("got"), F.regexp_replace(lowered, r"[^ a-z0-9\p{L}\p{N}_]+", " ").alias("want"), plain.alias("plain")
    ).collect()
    assert all(r.got == r.want for r in rows) and {r.plain for r in rows} == {True, False, None}
    # Letters aren't looked for one by one in texts without any beyond ASCII.
    assert r"\p{L}" not in df.select(text.words(F.col("c")))._jdf.queryExecution().analyzed().toString().split("ELSE")[0]
