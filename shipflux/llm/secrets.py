"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

Everything is DataFrame functions and Spark ML; no Python runs on the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import fresh, let
from shipflux.session import staged

# Shapes of keys that vendors publish, and words beside secrets.
FORMATS = {
    "aws_access_key": r"(?:AKIA|ASIA)[A-Z0-9]{16}",
    "github_token": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack_token": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "google_api_key": r"AIza[A-Za-z0-9_-]{35}",
    "json_web_token": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    # To its end line; without one, the full lines of the body that follow. No part repeats over another key.
    "private_key": r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*+(?:-(?!----(?:BEGIN|END))[^-]*+){0,1000}-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:\r?\n|\\n)[A-Za-z0-9+/=]{40,76}(?=\r?\n|\\n|\z)){0,400})",
}
SECRET_WORDS = r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?)"
BENIGN_WORDS = r"(?i)(?:sha\d*|md5|commit|checksum|digest|uuid|guid|order|invoice|phone|tel|card|isbn|version|build|revision)"
# Any other candidate: twelve or more of these characters, a digit among them, between other characters.
GENERAL = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}={0,2}(?![A-Za-z0-9+/_-])"
# The whole quoted or a bare value that a secret word is assigned, whatever it is made of; the word may be quoted
# too. What stands directly before is looked at first, which spares most places the longer look back.
ASSIGNS = r"(?<=[=:][ \t]{0,8}%s)(?<=(?i:passw(?:or)?d|passwd|pwd|secret(?:[_-]?key)?|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?)[\"']?[ \t]{0,8}[=:][ \t]{0,8}%s)"
QUOTED = r"(?:[^%s\\\r\n]++(?:\\.[^%s\\\r\n]*+){0,256}|(?:\\.[^%s\\\r\n]*+){1,256})(?=%s)"
ASSIGNED = "|".join(
    [
        *((ASSIGNS % (q, q)) + QUOTED.replace("%s", q) for q in ('"', "'")),
        ASSIGNS % ("[\"']?", "[\"']?") + r"[^\s\"'<>]{8,}",
    ]
)
CANDIDATE = "|".join([*(f"(?<![A-Za-z0-9_-]){p}(?![A-Za-z0-9_-])" for p in FORMATS.values()), ASSIGNED, GENERAL])
# Characters on either side that are looked at for neighbouring words.
NEARBY = 40
# Labelled findings the forest is fitted on, chosen by a hash, and words of the dictionary.
MAX_ROWS = 20_000
DICTIONARY = 5_000
TREES, DEPTH = 30, 6
FEATURES = (
    "length", "digits", "upper", "lower", "symbols", "transitions", "distinct", "entropy", "hexadecimal",
    "longest_letters", "coverage", "path_depth", "path_sample", "secret_before", "secret_near", "benign_before",
    "assigned", "quoted", "known_format",
)


def spans(text: Column) -> Column:
    """(start from 1, finding, before, after) of every candidate, left to right.

    The texts between the candidates come from the same pattern, so adding up
    lengths gives the places.
    """
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    between = F.split(text, CANDIDATE)

    def step(done, pair):
        start = done["end"] + F.length(pair["between"]) + 1
        span = F.struct(
            start.alias("start"),
            pair["found"].alias("finding"),
            F.right(pair["between"], F.lit(NEARBY)).alias("before"),
            F.left(pair["after"], F.lit(NEARBY)).alias("after"),
        )
        return F.struct((start + F.length(pair["found"]) - 1).alias("end"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def pairs(found, between):
        return F.transform(
            found,
            lambda f, i: F.struct(
                f.alias("found"), F.element_at(between, i + 1).alias("between"), F.element_at(between, i + 2).alias("after")
            ),
        )

    none = F.array().cast("array<struct<start:int,finding:string,before:string,after:string>>")
    start = F.struct(F.lit(0).alias("end"), none.alias("spans"))
    listed = let(found, lambda f: let(between, lambda b: F.aggregate(pairs(f, b), start, step, lambda done: done["spans"])))
    return F.when(F.regexp_like(text, F.lit(CANDIDATE)), listed).otherwise(none)


def candidates(docs: DataFrame, doc_id: str, text: str, path: str | None) -> DataFrame:
    """One row per candidate: doc_id, text_key (hash of the text), path, start, finding, before, after."""
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"),
        spans(F.col(text)).alias("spans"),
    )
    return rows.select("doc_id", "text_key", "path", F.inline("spans"))


def dictionary(docs: DataFrame, text: str, size: int = DICTIONARY) -> Column:
    """The most frequent words of four or more letters in all texts, as one array."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]{4,}"), F.lit(0))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").count()
    top = counts.orderBy(F.desc("count"), "word").limit(size).toArrow().column("word").to_pylist()
    return F.lit(top) if top else F.array().cast("array<string>")


def share_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def entropy(text: Column) -> Column:
    size = F.length(text)

    def part(c):
        share = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return -share * F.log2(share)

    return F.aggregate(F.transform(F.array_distinct(F.split(text, "")), part), F.lit(0.0), lambda a, b: a + b)


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def kind(finding: Column, before: Column) -> Column:
    """The vendor format of a finding; else assigned_secret beside a secret word; else high_entropy."""
    named = F.when(F.regexp_like(before, F.lit(SECRET_WORDS + r"\W{0,6}\z")), "assigned_secret").otherwise("high_entropy")
    for name, pattern in reversed(FORMATS.items()):
        named = F.when(F.regexp_like(finding, F.lit(rf"\A(?:{pattern})\z")), name).otherwise(named)
    return named


def featured(found: DataFrame, words: Column) -> DataFrame:
    """The features of every candidate as columns."""
    finding, before, after, path = (F.col(c) for c in ("finding", "before", "after", "path"))
    # A change of class between neighbours: letter case, digit or symbol.
    shape = F.regexp_replace(finding, "[a-z]", "a")
    for pattern, mark in (("[A-Z]", "A"), ("[0-9]", "0"), ("[^A-Za-z0-9]", "-")):
        shape = F.regexp_replace(shape, pattern, mark)
    runs = F.regexp_count(shape, F.lit("a+|A+|0+|-+"))
    letters = F.regexp_extract_all(F.lower(finding), F.lit("[a-z]{4,}"), F.lit(0))
    covered = F.aggregate(
        F.filter(letters, lambda w: F.array_contains(words, w)), F.lit(0), lambda n, w: n + F.length(w)
    )
    longest = F.array_max(F.transform(F.regexp_extract_all(finding, F.lit("[A-Za-z]+"), F.lit(0)), F.length))
    size = F.greatest(F.length(finding), F.lit(1))
    return found.withColumns(
        {
            "kind": kind(finding, before),
            "length": F.length(finding).cast("double"),
            "digits": share_of(finding, "[0-9]"),
            "upper": share_of(finding, "[A-Z]"),
            "lower": share_of(finding, "[a-z]"),
            "symbols": share_of(finding, "[^A-Za-z0-9]"),
            "transitions": (runs - 1) / size,
            "distinct": F.size(F.array_distinct(F.split(finding, ""))) / size,
            "entropy": entropy(finding),
            "hexadecimal": flag(F.regexp_like(finding, F.lit(r"\A[0-9a-fA-F]+\z"))),
            "longest_letters": F.coalesce(longest, F.lit(0)) / size,
            "coverage": covered / size,
            "path_depth": F.coalesce(F.regexp_count(path, F.lit("[/.]")), F.lit(0)).cast("double"),
            "path_sample": flag(F.regexp_like(path, F.lit(r"(?i)(?:test|example|sample|doc|fixture|mock)"))),
            "secret_before": flag(F.regexp_like(before, F.lit(SECRET_WORDS + r"\W{0,6}\z"))),
            "secret_near": flag(F.regexp_like(F.concat(before, F.lit(" "), after), F.lit(SECRET_WORDS))),
            "benign_before": flag(F.regexp_like(before, F.lit(BENIGN_WORDS + r"\W{0,6}\z"))),
            "assigned": flag(F.regexp_like(before, F.lit(r"[=:]\s*[\"']?\z"))),
            "quoted": flag(F.regexp_like(before, F.lit(r"[\"']\z"))),
            "known_format": flag(~F.col("kind").isin("assigned_secret", "high_entropy")),
        }
    )


def labelled_by_format(rows: DataFrame) -> DataFrame:
    """Findings whose nature their surroundings settle: `label` 1 (secret), 0 (not), others left out.

    Secrets: vendor formats, and mixed values a secret word is assigned. No secrets: digits
    only, parts of an address or number, values that a benign word names, dictionary words.
    """
    secret = (F.col("known_format") == 1) | (
        (F.col("secret_before") == 1) & (F.col("digits") > 0) & (F.col("distinct") * F.col("length") >= 6)
    )
    harmless = (
        (F.col("digits") == 1)
        | (F.col("benign_before") == 1)
        | (F.col("coverage") > 0.5)
        | F.regexp_like("before", F.lit(r"[@.]\z"))
        | F.regexp_like("after", F.lit(r"\A[@.]\w"))
    )
    label = F.when(secret, 1).when(harmless & (F.col("secret_near") == 0), 0)
    return rows.withColumn("label", label).filter("label IS NOT NULL")


@dataclass
class Forest:
    """Trees; without them every finding gets `score`."""

    trees: RandomForestClassificationModel | None
    score: float


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Forest:
    """A forest from featured findings with `label`, at most `max_rows`, those of the smallest hashes.

    Without findings of both classes there are no trees, and a finding scores the
    one class, or 1 without any: then nothing is waved through.
    """
    order = F.xxhash64("finding", "before", "after")
    chosen = labelled.orderBy(order, "finding", "before", "after").limit(max_rows)
    rows = staged(chosen.select("label", *FEATURES), "findings")
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        return Forest(None, 1.0 if not n or ones else 0.0)
    weighted = rows.withColumn("weight", F.when(F.col("label") == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones))))
    train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(weighted)
    return Forest(
        RandomForestClassifier(
            labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=7, subsamplingRate=0.8
        ).fit(train.select("features", F.col("label").cast("double"), "weight")),
        0.0,
    )


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per candidate: doc_id, text_key, start (from 1), finding, kind, score and is_secret.

    `labelled` holds featured findings with a label; without it, findings whose
    nature their surroundings settle teach the forest. Null and empty texts have no
    candidates; repeated rows give repeated findings; a null path has no features.
    """
    words = dictionary(docs, text)
    rows = staged(featured(candidates(docs, doc_id, text, path), words), "candidates")
    forest = fit(labelled if labelled is not None else labelled_by_format(rows))
    if forest.trees is None:
        scored = rows.withColumn("score", F.lit(forest.score))
    else:
        features = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
        scored = forest.trees.transform(features).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "text_key", "start", "finding", "kind", "score", (F.col("score") >= threshold).alias("is_secret")
    )


def redact(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source", mask: str = "[SECRET]"
) -> DataFrame:
    """`docs` with every secret in `text` replaced by `mask`; other columns and texts stay as they are.

    Findings belong to an id and a text, so rows of one id with other texts keep theirs.
    """
    found = scan(docs, doc_id, text, path).filter("is_secret")
    same_id, same_text, cuts = (fresh(docs, n) for n in ("same_id", "same_text", "cuts"))
    places = found.groupBy(F.col("doc_id").alias(same_id), F.col("text_key").alias(same_text)).agg(
        F.sort_array(F.collect_set(F.struct("start", F.length("finding").alias("size"))), asc=False).alias(cuts)
    )
    matched = F.col(doc_id).eqNullSafe(F.col(same_id)) & (F.xxhash64(F.col(text)) == F.col(same_text))
    # From the last to the first, so that the places before stay right.
    cut = F.aggregate(cuts, F.col(text), lambda t, c: F.overlay(t, F.lit(mask), c["start"], c["size"]))
    joined = docs.join(places, matched, "left")
    return joined.withColumn(text, F.when(F.col(cuts).isNull(), F.col(text)).otherwise(cut)).select(docs.columns)
