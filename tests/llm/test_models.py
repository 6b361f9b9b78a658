"""Models against plain formulas, bounded samples, and inputs of extreme form."""

import hashlib
import math
import time

import numpy as np
import pytest

from murmura.llm import learning, lines, quality, secrets, toxicity

DOCS = "doc_id long, text string"


def test_discriminant_equals_the_densities():
    """Margins from kept factors are differences of normal log densities, written with determinant and inverse."""
    rnd = np.random.default_rng(5)
    y = (np.arange(300) % 3 == 0).astype(int)
    x = rnd.normal(size=(300, 4)) @ rnd.normal(size=(4, 4)) + np.outer(y, [2.0, -1.0, 0.0, 0.5])
    rule = learning.Discriminant(shrinkage=0.3, ridge=0.02).fit(x, y)
    z = (x - x.mean(0)) / x.std(0)
    spread = [np.mean([np.outer(r, r) for r in z[y == c] - z[y == c].mean(0)], axis=0) for c in (0, 1)]
    share = [np.mean(y == c) for c in (0, 1)]
    pooled = share[0] * spread[0] + share[1] * spread[1]
    target = (pooled + np.diag(np.diag(pooled))) / 2
    logs = []
    for c in (0, 1):
        covariance = 0.7 * spread[c] + 0.3 * target + 0.02 * np.eye(4)
        apart = z - z[y == c].mean(0)
        squared = np.array([r @ np.linalg.inv(covariance) @ r for r in apart])
        logs.append(math.log(share[c]) - 0.5 * math.log(np.linalg.det(covariance)) - 0.5 * squared)
    assert rule.margin(x) == pytest.approx(logs[1] - logs[0], rel=1e-9, abs=1e-9)


def test_toxicity_features_by_hand():
    lexicon = toxicity.Lexicon({"fool": (9, 0), "fool-": (9, 1), "idio-": (5, 0)}, 20, 30)
    weight = lambda t, c: math.log((t + 0.5) / 21) - math.log((c + 0.5) / 31)
    text = "You FOOL! Foolish idiots, st*pid..."
    words = ["you", "fool", "foolish", "idiots", "st", "pid"]
    # "fool" is a word of the lexicon; the opening of "foolish" is "fool-", that of "idiots" "idio-".
    single, openings = weight(9, 0), [weight(9, 1), weight(5, 0)]
    letters = 3 + 4 + 7 + 6 + 2 + 3
    want = [
        single / 16, sum(openings) / 16, single, max(openings), int(single > 2), sum(w > 2 for w in openings), 1 / 16,
        6 / letters, 1 / len(text), 5 / len(text), 1 / 16, math.log1p(len(words)),
    ]
    assert lexicon.features(text) == pytest.approx(want)
    # A row the lexicon was counted on doesn't vouch for itself.
    assert lexicon.features("fool", 1)[2] == pytest.approx(weight(8, 0))
    assert lexicon.features("") == [0.0] * 12


def test_lexicon_terms_are_handed_on_in_parts():
    """Terms of many texts are counted, not listed: no part holds much more than the bound, and their sums are whole."""
    texts = [(f"word{'abcdefghij'[i % 10]} fool other{'xyz'[i % 3]}", i % 2) for i in range(2000)]
    parts = list(toxicity.term_rows(iter(texts), held=12))
    assert len(parts) > 1 and max(map(len, parts)) <= 12 + 9
    assert sum(map(len, parts)) < sum(len(set(toxicity.terms(t.split()))) for t, _ in texts) / 2
    found = {}
    for part in parts:
        for term, toxic, rows in part.itertuples(index=False):
            a, b = found.get(term, (0, 0))
            found[term] = a + toxic, b + rows
    expected = {}
    for text, y in texts:
        for term in set(toxicity.terms(text.split())):
            a, b = expected.get(term, (0, 0))
            expected[term] = a + y, b + 1
    assert found == expected
    assert not list(toxicity.term_rows(iter([])))


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_sample_has_one_row_of_an_id(spark, operator, label):
    """An id that very many rows repeat is one row of the sample, whatever their order."""
    rows = [(7, f"text number {i % 400}") for i in range(4000)] + [(i, f"own text {i}") for i in range(100, 160)] + [(None, "x"), (8, None)]
    marks = spark.createDataFrame([(i, i % 2) for i in [7, 8, *range(100, 160)]], f"doc_id long, {label} int")
    samples = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, DOCS).repartition(5)
        samples.append(sorted(map(tuple, learning.labelled_sample(docs, marks, label, 1000, -1, 1000).collect())))
    assert samples[0] == samples[1] and [r[0] for r in samples[0]] == [7, 8, *range(100, 160)]
    assert samples[0][1][1] == "" and samples[0][0][1] in {t for i, t in rows if i == 7}
    assert len(learning.labelled_sample(spark.createDataFrame(rows, DOCS), marks, label, 1000, -1, 20).collect()) == 20
    docs = spark.createDataFrame(rows, DOCS)
    assert operator.scored(docs, operator.fit(docs, marks)).count() == len(rows)


def test_long_words_are_read_once(spark):
    """Words of a million characters: letters only, a credential word over and over, addresses, one long value."""
    value = "a1" * 500_000
    texts = ["x" * 1_000_000, "token" * 200_000, "token:" * 160_000, "a://" * 250_000, value, "tok=" + "token" * 200_000 + "=Zk3v9Qm2Xw7"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    began = time.time()
    got = {(r.doc_id, r.value_sha256) for r in secrets.findings(docs).collect()}
    assert time.time() - began < 60
    digest = lambda v: hashlib.sha256(v.encode()).hexdigest()
    assert (4, digest(value)) in got and (5, digest("Zk3v9Qm2Xw7")) in got and not {i for i, _ in got} & {0, 1, 3}


def test_names_with_a_credential_word(spark):
    """What stands before the credential word of a name is left for other candidates; odd signs may join its parts."""
    texts = {
        "abc123def456ghi7890_token=Zk3v9Qm2": {"abc123def456ghi7890_", "Zk3v9Qm2"},
        "api/key=Zk3v9Qm2": {"Zk3v9Qm2"},
        "tokenapi/key=Zk3v9Qm2": {"Zk3v9Qm2"},
        "api key = Zk3v9Qm2": {"Zk3v9Qm2"},
        "a_token_b_secret:Zk3v9Qm2;pwd=Qq55Ww66": {"Zk3v9Qm2", "Qq55Ww66"},
        "abcdefghijklmnopqrst": set(),
    }
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {(r.doc_id, r.value) for r in secrets.candidates(docs).collect()}
    assert got == {(i, v) for i, values in enumerate(texts.values()) for v in values}


def test_many_equal_lines_of_one_text(spark):
    """200,000 equal lines between others: one stays, in its place."""
    text = "\n".join(["a first line of some words", *["the same line again and again"] * 200_000, "", "a last line of other things"])
    docs = spark.createDataFrame([(1, text), (2, "the same line again and again"), (3, None), (4, "")], DOCS)
    began = time.time()
    got = {r.doc_id: r for r in lines.deduplicated(docs).collect()}
    assert time.time() - began < 90
    assert got[1].text == "a first line of some words\nthe same line again and again\n\na last line of other things"
    assert (got[1].llm_lines, got[1].llm_removed) == (200_002, 199_999)
    assert (got[2].text, got[2].llm_removed, got[3].text, got[4].text) == ("", 1, None, "")
