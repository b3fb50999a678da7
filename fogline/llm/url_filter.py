"""URL verdicts by rules, and by gradient-boosted trees where no rule fits.

Method: trees are trained on labelled URLs, on lexical features only: lengths, path depth, digit ratio, character entropy,
number of parameters, hyphens, host parts, and statistics of the host's suffix (how common it is and its share of blocked URLs
among the other labelled ones, drawn to the overall share: a URL's own label is never part of its features). Labels are the rules' own
verdicts unless others are given. Everything is in DataFrame operations and Spark's tree learner, so training is spread like any other
job. Suffixes are pre-aggregated; the statistics come back by a join whose sides Spark sizes at run time. The features are written
once, so URLs are read twice (suffixes, features) and every round of the trees reads numbers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogline.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TREES, DEPTH, SEED = 10, 4, 7
#: Weight of the overall share in a suffix's share of blocked URLs.
PRIOR = 10.0
BLOCK, ALLOW = "block", "allow"
NUMBERS = (
    "url_length", "host_length", "path_length", "query_length", "depth", "parts", "digits", "entropy", "parameters", "hyphens",
    "suffix_common", "suffix_blocked",
)


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with all its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        return ((F.col("host") == self.host) | F.col("host").endswith("." + self.host)) & F.col("path").startswith(self.path)


def parse_rules(lines: list[str]) -> list[UrlRule]:
    """Rules from lines like ``block example.com/en/``: the path begins at the first slash."""
    rules = []
    for line in lines:
        verdict, _, place = line.strip().partition(" ")
        host, slash, path = place.strip().partition("/")
        if verdict not in (ALLOW, BLOCK) or not slash:
            raise ValueError(f"not a rule: {line!r}")
        rules.append(UrlRule(verdict, host, slash + path))
    return rules


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for NULL or without ``://``."""
    found = lambda group: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))
    return F.translate(found(1), UPPER, LOWER), found(2)


def apply_rules(pages: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """``pages`` (with host, path) plus rule and rule_verdict of the longest rule that fits, NULL if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    pick = lambda value: reduce(lambda c, r: c.when(r.fits(), F.lit(value(r))), ordered, F.when(F.lit(False), F.lit("")))
    return pages.withColumn("rule", pick(lambda r: r.name)).withColumn("rule_verdict", pick(lambda r: r.verdict))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c))) / size
    return F.aggregate(
        F.filter(F.array_distinct(letters), lambda c: c != ""), F.lit(0.0), lambda total, c: total - share(c) * F.log2(share(c))
    )


def lexical_features(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path) plus numbers about the spelling of the URL, and its suffix."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return pages.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "query_length": F.length(query).cast("double"),
            "depth": F.regexp_count("path", F.lit("/+[^/]")).cast("double"),
            "parts": F.regexp_count("host", F.lit(r"[^.]+")).cast("double"),
            "digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
            "entropy": _entropy(url),
            "parameters": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
            "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
            "suffix": F.regexp_extract("host", r"([^.]*)$", 1),
        }
    )


def suffix_statistics(featured: DataFrame) -> tuple[DataFrame, float]:
    """(suffix, urls, labelled, bad) over all URLs and the labelled ones (``blocked`` 0, 1 or NULL), and the share of blocked ones overall."""
    per = featured.groupBy("suffix").agg(
        F.count("*").alias("urls"), F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("bad")
    )
    overall = per.agg((F.sum("bad") / F.greatest(F.sum("labelled"), F.lit(1))).alias("share")).first()["share"] or 0.0
    return per.withColumnRenamed("suffix", "__suffix"), overall


def with_suffixes(featured: DataFrame) -> DataFrame:
    """``featured`` with suffix_common and suffix_blocked; a labelled URL does not count itself."""
    per, overall = suffix_statistics(featured)
    own, one = F.coalesce("blocked", F.lit(0)), F.col("blocked").isNotNull().cast("int")
    return featured.join(per, F.col("suffix") == F.col("__suffix")).withColumns(
        {
            "suffix_common": F.log1p("urls"),
            "suffix_blocked": (F.col("bad") - own + PRIOR * overall) / (F.col("labelled") - one + PRIOR),
        }
    )


def judge_urls(pages: DataFrame, rules: list[UrlRule], labels: Column | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) for every row of ``pages`` (page_id, url).

    ``verdict``: the longest fitting rule's, else ``block`` where the trees give 0.5 or more. ``labels`` is a column of ``pages``
    (1 block, 0 allow, NULL unknown) to learn from; without it the rules' verdicts are learned. NULL and odd URLs have
    empty host and path and are judged like all others; repeated rows are judged alike. If the labels hold only one verdict,
    that one holds everywhere; without any, ``allow``. Other columns are ignored.
    """
    given = F.lit(None).cast("int") if labels is None else labels.cast("int")
    host, path = host_and_path(F.col("url"))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", given.alias("given")).withColumns({"host": host, "path": path})
    ruled = apply_rules(read, rules)
    learned = F.when(F.col("rule_verdict") == BLOCK, 1).when(F.col("rule_verdict") == ALLOW, 0)
    featured = lexical_features(ruled.withColumn("blocked", learned if labels is None else F.col("given")))
    known = cut_lineage(
        with_suffixes(featured).select("page_id", "host", "path", "rule", "rule_verdict", "blocked", *(F.col(n).cast("double").alias(n) for n in NUMBERS))
    )
    found = {r["blocked"] for r in known.where("blocked IS NOT NULL").select("blocked").distinct().collect()}
    if found == {0, 1}:
        ready = VectorAssembler(inputCols=list(NUMBERS), outputCol="features").transform(known)
        trees = GBTClassifier(labelCol="blocked", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
        model = trees.fit(ready.where("blocked IS NOT NULL").select("features", F.col("blocked").cast("double").alias("blocked")))
        judged = model.transform(ready).withColumn("block_score", vector_to_array("probability")[1])
    else:
        judged = known.withColumn("block_score", F.lit(1.0 if found == {1} else 0.0))
    verdict = F.coalesce("rule_verdict", F.when(F.col("block_score") >= 0.5, BLOCK).otherwise(ALLOW))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
