"""URL verdicts: path rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame expressions and Spark ML; rules label the URLs the
trees learn from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"


@dataclass(frozen=True)
class Rule:
    """A host suffix and a path prefix, written ``host/path``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2] if self.text.partition("/")[2] else "/"

    def fits(self, host: Column, path: Column) -> Column:
        on_host = (host == self.host) | host.endswith("." + self.host)
        return on_host & path.startswith(self.path)


RULES = (
    Rule(BLOCK, "net/"),
    Rule(ALLOW, "example.net/en/"),
    Rule(BLOCK, "example.com/de/"),
    Rule(ALLOW, "org/fr/"),
)

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "dash_ratio", "host_entropy",
    "path_entropy", "parameters", "query_length", "fragment_length", "secure", "suffix_weight", "domain_weight",
)


def with_parts(pages: DataFrame) -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both are empty for null or without ``://``."""
    after = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    rest = F.expr("substring(after, length(raw_host) + 1)")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        pages.withColumn("after", F.coalesce(after, F.lit("")))
        .withColumn("raw_host", F.coalesce(host, F.lit("")))
        .withColumn("path", F.regexp_extract(rest, r"^[^?#]*", 0))
        .withColumn("host", F.translate("raw_host", letters, letters.lower()))
        .drop("after", "raw_host")
    )


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text of the longest rule that fits (ties: the first given), else null."""
    choice = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        choice = F.when(rule.fits(host, path), F.lit(rule.text)).otherwise(choice)
    return choice


def entropy(text: Column) -> Column:
    """Bits per character; 0 for empty text."""
    n = F.length(text)
    characters = F.split(text, "")
    bits = F.aggregate(
        F.array_distinct(characters),
        F.lit(0.0),
        lambda total, c: total
        + F.when(c == "", F.lit(0.0)).otherwise(
            (lambda share: -share * F.log2(share))((n - F.length(F.replace(text, c, F.lit("")))) / n)
        ),
    )
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def _domain(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(pages: DataFrame) -> DataFrame:
    """Add the features that need nothing but the URL itself."""
    url, path, host = F.coalesce("url", F.lit("")), F.col("path"), F.col("host")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"#(.*)$", 1)
    length = F.length(url)
    share = lambda pattern: F.when(length > 0, F.regexp_count(url, F.lit(pattern)) / length).otherwise(F.lit(0.0))
    return pages.withColumns(
        {
            "url_length": length.cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.regexp_count(path, F.lit("/[^/]")).cast("double"),
            "labels": F.regexp_count(host, F.lit("[^.]+")).cast("double"),
            "digit_ratio": share("[0-9]"),
            "dash_ratio": share("[-_%~]"),
            "host_entropy": entropy(host),
            "path_entropy": entropy(path),
            "parameters": F.when(query == "", F.lit(0.0)).otherwise((F.regexp_count(query, F.lit("&")) + 1).cast("double")),
            "query_length": F.length(query).cast("double"),
            "fragment_length": F.length(fragment).cast("double"),
            "secure": url.startswith("https://").cast("double"),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    """Fitted trees and the share of blocked URLs by host suffix among the labelled ones."""

    trees: PipelineModel | None
    suffixes: DataFrame
    domains: DataFrame
    prior: float


def _statistics(labelled: DataFrame, name: str, labels: int, prior: float, smoothing: float = 20.0) -> DataFrame:
    """Smoothed share of blocked URLs per last ``labels`` labels of the host; combined before the shuffle."""
    return labelled.groupBy(_domain(F.col("host"), labels).alias(name)).agg(
        ((F.sum("label") + smoothing * prior) / (F.count("*") + smoothing)).alias(f"{name}_weight")
    )


def with_statistics(rows: DataFrame, suffixes: DataFrame, domains: DataFrame, prior: float) -> DataFrame:
    """Add both suffix statistics; a suffix never labelled gets the overall share."""
    for name, labels, table in (("suffix", 1, suffixes), ("domain", 2, domains)):
        rows = rows.withColumn(name, _domain(F.col("host"), labels)).join(table, name, "left").drop(name)
        rows = rows.fillna(prior, [f"{name}_weight"])
    return rows


def fit(labelled: DataFrame, *, sample: int = 20_000, trees: int = 10, depth: int = 4) -> UrlModel:
    """Fit on rows with ``page_id, url, host, path, label`` (1.0: block).

    Suffix statistics are counted over all labelled rows.  The trees see at most ``sample`` of them, those with the
    smallest hash of the URL.  With one class only, or none, there are no trees and the overall share decides.
    """
    spark = labelled.sparkSession
    total = labelled.agg(F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("share")).first()
    prior = float(total["share"])
    suffixes, domains = _statistics(labelled, "suffix", 1, prior), _statistics(labelled, "domain", 2, prior)
    if prior in (0.0, 1.0):
        return UrlModel(None, suffixes, domains, prior)
    chosen = labelled.select("url", "host", "path", "label").orderBy(F.xxhash64("url"), "url").limit(sample)
    rows = with_statistics(lexical(chosen), suffixes, domains, prior).select("label", *FEATURES)
    rows = rows.repartition(max(2, spark.sparkContext.defaultParallelism // 2))
    stages = [
        VectorAssembler(inputCols=list(FEATURES), outputCol="features"),
        GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, checkpointInterval=-1),
    ]
    return UrlModel(Pipeline(stages=stages).fit(rows), suffixes, domains, prior)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, *, sample: int = 20_000) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    The longest rule that fits a URL decides; the others get the verdict of trees fitted on the URLs that rules
    decide.  Null and malformed URLs have empty host and path, and are judged by their features like others.
    Repeated rows are answered each; other columns are ignored; an empty table gives no rows; without a rule that
    fits any URL everything is allowed.
    """
    parts = with_parts(pages.select("page_id", F.col("url").cast("string").alias("url")))
    parts = parts.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule in rules:
        by_rule = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(by_rule)
    parts = parts.withColumn("by_rule", by_rule)
    labelled = parts.where(F.col("rule").isNotNull()).withColumn("label", (F.col("by_rule") == BLOCK).cast("double"))
    model = fit(labelled, sample=sample)
    answered = parts.where(F.col("rule").isNotNull()).select("page_id", "host", "path", "rule", F.col("by_rule").alias("verdict"))
    open_ = parts.where(F.col("rule").isNull())
    if model.trees is None:
        verdict = F.lit(BLOCK if model.prior == 1.0 else ALLOW)
        guessed = open_.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    else:
        scored = model.trees.transform(with_statistics(lexical(open_), model.suffixes, model.domains, model.prior))
        verdict = F.when(F.col("prediction") == 1.0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
        guessed = scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    return answered.unionByName(guessed)
