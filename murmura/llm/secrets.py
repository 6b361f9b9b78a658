"""Secret scan: candidate strings, and a random forest that sorts out false positives.

Candidates are values assigned to a credential word (``password=``, ``"api_key":``, ``token =`` before the
word, or the password of ``scheme://user:password@``) of four or more characters, and, in what is left of a word, all
long runs of letters and digits with a digit among them. Every candidate of a word is a finding. Their features (length,
character transitions, dictionary coverage, path marks, neighbouring words) are column expressions and
the forest is Spark's own, trained on a bounded sample of labelled findings. DataFrame operations only.

Cases: null and empty texts have no candidates; null ids are kept; rows that repeat an id have their
findings each; further columns are not read. Labelled findings of one class only give that class's
share as the score, none give 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import remainder, stored, words

#: At most so many labelled findings are learned from; documented bound of the sample.
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 6, 17
THRESHOLD = 0.5
MODULUS, HELD_OUT = 3, 1

#: A whole run of these characters, with a digit; tried at the start of a run only, so that a long word is read once.
SHORTEST = 16
CANDIDATE = rf"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{{{SHORTEST},}}+"
CREDENTIAL = r"(?i)passw|pwd|secret|token|api.?key|access.?key|auth|credential"
#: What links a credential word to its value; the ``:`` of ``https://`` doesn't.
ASSIGN = r"(?:=>|:=|={1,2}|:(?!//))"
LINK = CREDENTIAL.removeprefix("(?i)")
NAME = "A-Za-z0-9_.-"
#: A name up to its end, with a credential word in it; the group is what comes before that. Names are tried as a whole.
CREDENTIAL_NAME = rf"(?:(?<![{NAME}])(?>([{NAME}]*?)(?:{LINK})[{NAME}]*+)|(?:api|access)[^{NAME}]key[{NAME}]*+)"
#: A value that a credential word or an address names, as the second group; of an address the sign ``@`` stays.
NAMED = (
    rf"(?i)(?:{CREDENTIAL_NAME}[\"'`\]]*+{ASSIGN}[\"'`(\[{{]*|(?<![a-z0-9+.-])[a-z0-9+.-]++://[^\s/:@?#]*:(?=[^\s/]+@))"
    r"((?<=://[^\s/:@?#]{0,200}:)[^\s/]{4,}(?=@)|[^\s\"'`,;&<>(){}\[\]]{4,})"
)
#: The end of the words before, when they assign to a credential word.
BEFORE = rf"(?i){CREDENTIAL_NAME}[\"'`\]]*+ ?{ASSIGN}[\"'`(]*$"
# Parts of everyday identifiers.
DICTIONARY = (
    r"(?i)example|sample|test|user|name|file|image|page|index|data|version|build|mail|number|order|invoice|"
    r"document|report|license|article|chapter|section|http|www|html|json|config|default|null|true|false"
)
FEATURES = [
    "length", "transitions", "digits", "capitals", "variety", "dictionary", "slashes", "hex", "only_digits",
    "credential_before", "assigned", "quoted", "mail", "web", "named",
]


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: ``doc_id``, ``place`` (its word), ``at`` (which of the word's candidates),
    ``value``, ``named`` (a credential word is assigned to it) and the words about it."""
    listed = docs.select(docs["doc_id"], words(docs["text"]).alias("w"))
    each = F.transform("w", lambda x, i: F.struct(i.alias("place"), x.alias("word")))
    # No pattern below fits without these, and few words have them: the others get no neighbours and no row.
    linked = lambda x: F.contains(x, F.lit("=")) | F.contains(x, F.lit(":"))
    near = F.filter(
        each,
        lambda x: (F.length(x["word"]) >= SHORTEST) | linked(x["word"]) | F.coalesce(linked(F.get("w", x["place"] - 1)), F.lit(False)),
    )
    about = F.transform(
        near,
        lambda x: F.struct(
            x["place"].alias("place"),
            x["word"].alias("word"),
            F.concat_ws(" ", *[F.get("w", x["place"] - k) for k in (3, 2, 1)]).alias("before"),
            F.coalesce(F.get("w", x["place"] + 1), F.lit("")).alias("after"),
        ),
    )
    found = listed.select("doc_id", F.inline(about))
    found = found.where(F.col("word").rlike(CANDIDATE) | F.col("word").rlike(NAMED) | F.col("before").rlike(BEFORE))
    # A word that the words before assign to reads as if they were written to it.
    whole = F.when(F.col("before").rlike(BEFORE) & ~F.col("word").rlike(NAMED), F.concat(F.lit("token="), F.col("word"))).otherwise(F.col("word"))
    found = found.withColumn("read", whole)
    named, left = F.regexp_extract_all("read", F.lit(NAMED), F.lit(2)), F.regexp_replace("read", NAMED, "$1\u0001")
    each = F.concat(
        F.transform(named, lambda v: F.struct(v.alias("value"), F.lit(True).alias("named"))),
        F.transform(F.regexp_extract_all(left, F.lit(f"({CANDIDATE})"), F.lit(1)), lambda v: F.struct(v.alias("value"), F.lit(False).alias("named"))),
    )
    rows = found.select("doc_id", "place", "word", "before", "after", F.posexplode(each).alias("at", "one"))
    return rows.select("doc_id", "place", "at", "word", "before", "after", "one.value", F.col("one.named").cast("double").alias("named"))


def with_features(found: DataFrame) -> DataFrame:
    n = F.length("value")
    count = lambda pattern, c="value": F.regexp_count(c, F.lit(pattern)).cast("double")
    flag = lambda c: c.cast("double")
    before = F.concat_ws(" ", F.col("before"), F.col("word"))
    changes = r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])|[A-Z](?=[a-z])"
    return found.withColumns(
        {
            "length": n.cast("double"),
            "transitions": count(changes) / n,
            "digits": count("[0-9]") / n,
            "capitals": count("[A-Z]") / n,
            "variety": F.size(F.array_distinct(F.split("value", ""))) / n,
            "dictionary": 1 - F.length(F.regexp_replace("value", DICTIONARY, "")) / n,
            "slashes": count("[/.]", "word") / n,
            "hex": flag(F.col("value").rlike(r"^[0-9a-f]+$")),
            "only_digits": flag(F.col("value").rlike(r"^[0-9]+$")),
            "credential_before": flag(before.rlike(CREDENTIAL)),
            "assigned": flag(before.rlike(r"[=:]")),
            "quoted": flag(F.col("word").rlike("[\"'`]")),
            "mail": flag(F.col("word").contains("@")),
            "web": flag(F.col("word").rlike(r"(?i)https?:|www\.")),
        }
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings whose nature a strict rule settles, with ``label``: the corpus has no table of findings.

    Secret: named by a credential word or in the format of a cloud access key, wherever it stands. Not
    secret: other parts of mail and web addresses, digits only, and candidates with neither credential word
    nor assignment nearby. Other candidates with both nearby are secret.
    """
    label = (
        F.when(F.col("value").rlike(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])") | (F.col("named") == 1), 1)
        .when((F.col("mail") == 1) | (F.col("web") == 1) | (F.col("only_digits") == 1), 0)
        .when((F.col("credential_before") == 1) & (F.col("assigned") == 1), 1)
        .when((F.col("credential_before") == 0) & (F.col("assigned") == 0), 0)
    )
    return found.withColumn("label", label).where("label is not null")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def scored(found: DataFrame, labelled: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``found`` with ``score``: the forest's probability that it is a secret."""
    sample = (
        labelled.select("label", *FEATURES, F.xxhash64("doc_id", "place", "at", "value").alias("drawn"))
        .orderBy("drawn")
        .limit(bound)
        .withColumn("label", F.col("label").cast("double"))
    )
    sample = stored(sample, "secrets-sample")
    shares = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(shares) < 2:
        return found.withColumn("score", F.lit(1.0 if 1.0 in shares else 0.0))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    model = forest.fit(_assembled(sample))
    return model.transform(_assembled(found)).withColumn("score", vector_to_array("probability")[1])


def findings(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: ``doc_id``, ``place``, ``length``, ``value_sha256``, ``score``, ``secret``, ``at``.

    ``labelled`` holds findings with features and ``label``; by default those that strict rules settle.
    """
    found = stored(with_features(candidates(docs)), "secrets-candidates")
    if labelled is None:
        labelled = rule_labels(found.where(remainder("doc_id", MODULUS) != HELD_OUT))
    return scored(found, labelled).select(
        "doc_id",
        F.col("place").cast("long").alias("place"),
        F.length("value").cast("long").alias("length"),
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        F.round("score", 6).alias("score"),
        (F.col("score") >= THRESHOLD).alias("secret"),
        F.col("at").cast("long").alias("at"),
    )
