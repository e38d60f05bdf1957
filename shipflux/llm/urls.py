"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Everything is worked out by Spark SQL functions and Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Labelled urls the trees are fitted on, chosen by a hash of the url.
MAX_ROWS = 20_000
# Weight of the overall share beside a suffix's own labels.
PRIOR = 10.0
TREES, DEPTH = 20, 4
NUMBERS = (
    "url_length", "host_length", "path_length", "path_depth", "host_depth", "digit_ratio",
    "host_digits", "hyphens", "entropy", "host_entropy", "parameters", "fragments",
)
# Endings of the host, the ending of the path's last part, and its first part.
SUFFIXES = ("suffix1", "suffix2", "extension", "section")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        """The host or a subdomain, with a path that begins as the rule's does."""
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without a ://."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: list[Rule], value) -> Column:
    """`value(rule)` of the longest rule that fits, or null; of two equally long ones the smaller text."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        chosen = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(chosen)
    return chosen


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)

    def part(c):
        share = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return -share * F.log2(share)

    chars = F.array_distinct(F.split(text, ""))
    return F.when(size > 0, F.aggregate(F.transform(chars, part), F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def featured(pages: DataFrame) -> DataFrame:
    """The lexical features of url, host and path as columns; a null url counts as empty."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    after = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, "\\.")
    return pages.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "path_depth": count_of(path, "/[^/]"),
            "host_depth": count_of(host, "\\."),
            "digit_ratio": F.when(F.length(url) > 0, count_of(url, "[0-9]") / F.length(url)).otherwise(0.0),
            "host_digits": count_of(host, "[0-9]"),
            "hyphens": count_of(host, "-"),
            "entropy": let(url, entropy),
            "host_entropy": let(host, entropy),
            "parameters": count_of(after, "[^&]+"),
            "fragments": count_of(url, "#"),
            "suffix1": F.element_at(labels, -1),
            "suffix2": F.substring_index(host, ".", -2),
            "extension": F.regexp_extract(path, r"(\.[^./]*)\z", 1),
            "section": F.regexp_extract(path, r"\A/([^/]*)", 1),
        }
    )


def with_shares(rows: DataFrame, shares: dict[str, DataFrame]) -> DataFrame:
    """The smoothed blocked share of each ending. The tables have at most one row per fitting url."""
    for suffix, share in shares.items():
        n, blocked = F.coalesce(F.col(f"{suffix}_n"), F.lit(0)), F.coalesce(F.col(f"{suffix}_blocked"), F.lit(0))
        rows = rows.join(F.broadcast(share), suffix, "left").withColumn(
            f"{suffix}_share", (blocked + PRIOR / 2) / (n + PRIOR)
        )
    return rows


@dataclass
class Filter:
    """Trees with the suffix statistics they read; without trees every url gets `verdict`."""

    trees: GBTClassificationModel | None
    shares: dict[str, DataFrame]
    verdict: str


INPUTS = [*NUMBERS, *(f"{s}_share" for s in SUFFIXES)]


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Filter:
    """Trees from rows with url, host, path and blocked (0 or 1), at most `max_rows` of them.

    The rows with the smallest hashes of the url are taken, so suffix statistics have
    at most as many rows and may be broadcast. Without rows of both classes there
    are no trees, and the one class (allow without rows) is the verdict. A half
    without rows or with one class still gives trees, or statistics, of that class.
    """
    chosen = labelled.select("url", "host", "path", "blocked").orderBy(F.xxhash64("url"), "url").limit(max_rows)
    rows = featured(chosen).cache()
    n, blocked = rows.agg(F.count("*"), F.sum("blocked")).first()
    if not n or blocked in (0, n):
        rows.unpersist()
        return Filter(None, {}, "block" if n and blocked else "allow")
    # One half gives the statistics, the other grows the trees: no row sees its own label.
    half = F.crc32(F.col("url").cast("binary")) % 2 == 0
    spark = labelled.sparkSession
    tables = {}
    for s in SUFFIXES:
        counted = rows.filter(half).groupBy(s).agg(F.count("*"), F.sum("blocked")).toArrow()
        tables[s] = spark.createDataFrame(counted.rename_columns([s, f"{s}_n", f"{s}_blocked"]))
    train = with_shares(rows.filter(~half), tables).withColumn(
        "weight", F.when(F.col("blocked") == 1, n / (2 * blocked)).otherwise(n / (2 * (n - blocked)))
    )
    train = VectorAssembler(inputCols=INPUTS, outputCol="features").transform(train)
    trees = GBTClassifier(
        labelCol="blocked", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, checkpointInterval=-1
    ).fit(train.select("features", F.col("blocked").cast("double"), "weight"))
    rows.unpersist()
    return Filter(trees, tables, "")


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", max_rows: int = MAX_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' block_score of every row.

    The longest fitting rule decides; its urls are also the labelled ones the trees
    learn from, and the trees decide where no rule fits. A null url, or one without
    ://, has an empty host and path. Repeated rows are judged alike.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    rows = rows.withColumns(
        {
            "rule": ruled(host, path, rules, lambda r: r.text),
            "by_rule": ruled(host, path, rules, lambda r: r.verdict),
        }
    )
    labelled = rows.filter("by_rule IS NOT NULL").withColumn("blocked", (F.col("by_rule") == "block").cast("int"))
    model = fit(labelled, max_rows)
    if model.trees is None:
        scored = rows.withColumn("block_score", F.lit(1.0 if model.verdict == "block" else 0.0))
    else:
        scored = with_shares(featured(rows), model.shares)
        scored = VectorAssembler(inputCols=INPUTS, outputCol="features").transform(scored)
        scored = model.trees.transform(scored)
        scored = scored.withColumn("block_score", vector_to_array("probability")[1])
    by_trees = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), "block_score")
