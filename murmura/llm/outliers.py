"""Quality rules with robust multivariate outliers per language and source, as DataFrame expressions only.

Each document has counts of words, characters, symbols, repeated lines and repeated word windows; two
plain rules fail the worst. The others' transformed statistics get a minimum-covariance-determinant
estimate per language and source, and also per language and over all: concentration steps refit mean and
covariance on the three quarters of rows nearest by Mahalanobis distance. Each group takes two steps from three
starts (medians with quartile ranges, all rows, the rows inside the quartile ranges); the one of the smallest
determinant goes on until no group's determinant falls any more. Distances come from Cholesky factors written as
column arithmetic; a document far beyond the chi-squared range goes.

A group keeps its own centre. Its covariance is mixed with its language's, and that with the one over all,
by weights ``n / (n + SHRINKAGE)``, so that no number of rows changes the way a group is judged. Sums per
group are combined on the map side, so a group of a third of all rows is no burden to one task. The estimates
are stored tables, so that Spark broadcasts them when their measured size is below its threshold, and else joins by
group and splits large ones.

Cases: a null text counts as empty and fails the base rule; null languages and sources are groups of
their own; rows that repeat an id each get a row; further columns are not read; groups whose statistics
do not vary have their variances floored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import WORD, stored, whole, words

WINDOW = 5
MIN_WORDS = 10
#: Share of rows a concentration step keeps, and the chi-squared (5) value below which so many fall.
COVERAGE, CHI_COVERAGE = 0.75, 6.6257
#: Squared distance beyond which a document goes: chi-squared (5), about one in a million.
CUTOFF = 35.9
#: Concentration steps from every start, most steps after them (few are needed), and a fall in the logarithm of a determinant.
STEPS, MOST_STEPS, FALL = 2, 12, 1e-3
#: Rows of a group at which its own covariance and the wider one weigh the same.
SHRINKAGE = 20
#: Floors of the standard deviations of the five statistics, in their order.
FLOORS = (0.25, 0.08, 0.06, 0.2, 0.15)
DIMENSIONS = len(FLOORS)
X = [f"x{i}" for i in range(DIMENSIONS)]
#: The entries of a covariance, above the diagonal and on it.
C = [f"c{i}{j}" for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
#: The name of the group of all rows.
ALL = "all"


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the counts of every row."""
    text = docs.select(docs["doc_id"], docs["lang"], docs["source"], whole(docs["text"]).alias("text"))
    counts = text.select(
        "doc_id",
        "lang",
        "source",
        words("text").alias("words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    others = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    sized = counts.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    ).select(*others, "words")
    # Each step is a column of its own: inside a lambda the step before would be computed for every element.
    hashed = sized.select(
        *others,
        F.transform(
            F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
            lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WINDOW)]),
        ).alias("windows"),
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ranked = hashed.select(
        *others,
        F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ranked"),
    )
    same = lambda x, j: F.coalesce(F.get("ranked", j)["h"] == x["h"], F.lit(False))
    starts = ranked.select(
        *others,
        F.sort_array(
            F.transform(F.filter("ranked", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])
        ).alias("starts"),
    )
    spans = F.transform("starts", lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", j + 1) - s, F.lit(WINDOW))))
    covered = F.aggregate(spans, F.lit(0), lambda a, b: a + b)
    return starts.select(*others, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def with_statistics(counts: DataFrame) -> DataFrame:
    """``base_failed`` and the five transformed statistics."""
    n = F.greatest("n_words", F.lit(1))
    share = lambda c, of: F.sqrt(F.col(c) / of)
    return counts.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    ).withColumns(
        {
            "x0": F.log1p("n_words"),
            "x1": F.log1p(F.col("word_chars") / n),
            "x2": share("n_symbols", F.greatest("word_chars", F.lit(1))),
            "x3": share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
            "x4": share("n_repeat_words", n),
        }
    )


def _factor(moments: DataFrame, *also: str) -> DataFrame:
    """``group``, means and the Cholesky factor of the floored covariance; and the columns ``also``."""
    table = moments.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + F.lit(FLOORS[i] ** 2) for i in range(DIMENSIONS)})
    for j in range(DIMENSIONS):  # column by column
        done = lambda i: reduce(Column.__add__, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))  # noqa: E731, B023
        table = table.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - done(j), F.lit(FLOORS[j] ** 2 / 4))))
        if j + 1 < DIMENSIONS:
            table = table.withColumns(
                {f"l{i}{j}": (F.col(f"c{j}{i}") - done(i)) / F.col(f"l{j}{j}") for i in range(j + 1, DIMENSIONS)}
            )
    return table.select(
        "group", *[f"m{i}" for i in range(DIMENSIONS)], *[f"l{i}{j}" for i in range(DIMENSIONS) for j in range(i + 1)], *also
    )


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Rows with ``distance``, the squared Mahalanobis distance from their group's estimate."""
    needed = [f"m{i}" for i in range(DIMENSIONS)] + [f"l{i}{j}" for i in range(DIMENSIONS) for j in range(i + 1)]
    joined = rows.join(estimate.select("group", *needed), "group")
    for i in range(DIMENSIONS):  # forward substitution
        rest = F.col(X[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        joined = joined.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    distance = reduce(Column.__add__, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIMENSIONS)])
    return joined.select(*rows.columns, distance.alias("distance"))


def _range(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group").agg(F.percentile_approx("distance", COVERAGE, 2000).alias("range"))


def _moments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group").agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(X)],
        *[F.covar_pop(X[i], X[j]).alias(f"c{i}{j}") for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)],
    )


def _log_determinant() -> Column:
    return reduce(Column.__add__, [2 * F.log(f"l{i}{i}") for i in range(DIMENSIONS)])


def _with_factor(moments: DataFrame, name: str) -> DataFrame:
    """Moments, stored once with their factor and ``size``, the logarithm of the determinant."""
    factor = _factor(moments.select("*", *[F.col(c).alias(f"_{c}") for c in C]), *[f"_{c}" for c in C])
    return stored(factor.select("*", _log_determinant().alias("size")).withColumnsRenamed({f"_{c}": c for c in C}), name)


def _step(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Moments and factor of the three quarters of each group that lie nearest by the estimate before."""
    distances = _distances(rows, estimate)
    near = distances.join(_range(distances), "group").where("distance <= range")
    return _with_factor(_moments(near), "outliers-step")


def _starts(rows: DataFrame) -> DataFrame:
    """Moments of three starts; the number of the start comes before the name of the group."""
    quartiles = rows.groupBy("group").agg(*[F.percentile_approx(x, [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i, x in enumerate(X)])
    quartiles = stored(quartiles, "outliers-quartiles")
    spread = [F.col(f"q{i}")[2] - F.col(f"q{i}")[0] for i in range(DIMENSIONS)]
    plain = quartiles.select(
        "group",
        *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIMENSIONS)],
        *[(F.pow(spread[int(c[1])] / 1.349, F.lit(2.0)) if c[1] == c[2] else F.lit(0.0)).alias(c) for c in C],
    )
    inside = [F.col(x).between(F.col(f"q{i}")[0] - F.lit(FLOORS[i]), F.col(f"q{i}")[2] + F.lit(FLOORS[i])) for i, x in enumerate(X)]
    middle = rows.join(quartiles, "group").where(reduce(Column.__and__, inside))
    named = [
        table.withColumn("group", F.concat(F.lit(f"{k}"), "group")) for k, table in enumerate([plain, _moments(rows), _moments(middle)])
    ]
    return _with_factor(reduce(DataFrame.unionByName, named), "outliers-starts")


def estimates(rows: DataFrame) -> DataFrame:
    """Per ``group`` of ``rows``: mean and covariance of the three quarters whose covariance has the smallest determinant found."""
    estimate = _starts(rows)
    thrice = rows.select(F.explode(F.array(*[F.concat(F.lit(f"{k}"), "group") for k in range(3)])).alias("group"), *X)
    for _ in range(STEPS):
        estimate = _step(thrice, estimate)
    columns = [c for c in estimate.columns if c != "group"]
    best = estimate.groupBy(F.expr("substring(group, 2)").alias("name")).agg(
        F.min_by(F.struct(*columns), F.struct("size", "group")).alias("best")
    )
    estimate = best.select(F.col("name").alias("group"), "best.*")
    estimate = stored(estimate, "outliers-best")
    for _ in range(MOST_STEPS):
        after = _step(rows, estimate)
        # A group whose determinant no longer falls keeps the estimate it has.
        both = estimate.select("group", F.struct(*columns).alias("old")).join(
            after.select("group", F.struct(*columns).alias("new")), "group"
        )
        fell = F.col("new.size") < F.col("old.size") - FALL
        both = stored(both.select("group", fell.alias("fell"), F.when(fell, F.col("new")).otherwise(F.col("old")).alias("kept")), "outliers-kept")
        estimate = both.select("group", "kept.*")
        if both.where("fell").isEmpty():
            break
    return estimate


def shrunk(groups: DataFrame, moments: DataFrame) -> DataFrame:
    """Per ``group`` its ``weight``, own means, and covariance mixed with those of its ``wide`` group and of all.

    ``groups`` has ``group``, ``wide`` and their numbers of rows ``n`` and ``wide_n``.
    """
    named = lambda p: moments.select(F.col("group").alias(f"{p}group"), *[F.col(c).alias(f"{p}{c}") for c in C])
    wider = groups.select(F.col("wide").alias("wgroup"), "wide_n").distinct().join(named("w"), "wgroup")
    over = moments.where(F.col("group") == ALL).select(*[F.col(c).alias(f"a{c}") for c in C], F.lit(ALL).alias("all"))
    wider = wider.withColumn("all", F.lit(ALL)).join(F.broadcast(over), "all")  # one row
    mixed = lambda n, own, other: (F.col(n) * F.col(own) + SHRINKAGE * F.col(other)) / (F.col(n) + SHRINKAGE)
    wider = wider.select(F.col("wgroup").alias("wide"), *[mixed("wide_n", f"w{c}", f"a{c}").alias(f"w{c}") for c in C])
    own = groups.join(moments, "group").join(wider, "wide")
    return own.select(
        "group",
        (F.col("n") / (F.col("n") + SHRINKAGE)).alias("weight"),
        *[f"m{i}" for i in range(DIMENSIONS)],
        *[mixed("n", c, f"w{c}").alias(c) for c in C],
    )


def judged(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed`` and ``kept``."""
    rows = with_statistics(counted(docs)).withColumns(
        {"group": F.concat(F.lit("s"), F.to_json(F.struct("lang", "source"))), "wide": F.concat(F.lit("l"), F.to_json(F.struct("lang")))}
    )
    rows = stored(rows, "outliers-statistics")
    passed = rows.where("not base_failed").select("group", "wide", *X)
    levels = passed.select(F.explode(F.array("group", "wide", F.lit(ALL))).alias("group"), *X)
    groups = passed.groupBy("group", "wide").agg(F.count("*").alias("n"))
    wider = groups.groupBy("wide").agg(F.sum("n").alias("wide_n"))
    mixed = stored(shrunk(stored(groups.join(wider, "wide"), "outliers-groups"), estimates(levels)), "outliers-shrunk")
    factor = stored(_factor(mixed), "outliers-estimate")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    measured = stored(_distances(rows.where("not base_failed").select("group", *columns, *X), factor), "outliers-distances")
    ranges = _range(measured).join(mixed.select("group", "weight"), "group")
    # The range is scaled to that of the chi-squared distribution, so that the cutoff means the same everywhere.
    # A few rows say little about their range, and count by their weight.
    own = F.col("weight") * F.col("range") + (1 - F.col("weight")) * F.lit(CHI_COVERAGE)
    scale = F.lit(CHI_COVERAGE) / F.greatest(own, F.lit(CHI_COVERAGE / 4))
    verdict = measured.join(ranges.select("group", scale.alias("scale")), "group")
    kept = verdict.select(*columns, (F.col("distance") * F.col("scale") <= CUTOFF).alias("kept"))
    return kept.unionByName(rows.where("base_failed").select(*columns, F.lit(False).alias("kept")))
