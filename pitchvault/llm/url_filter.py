"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from the URLs that a rule judges. Features are length, depth, digit ratio,
character entropy, parameter counts and the like, and statistics of host suffixes: how many
labelled URLs share the last one or two labels, and how many of them are blocked (all
labelled URLs count). The trees are fitted on at most ``SAMPLE`` labelled URLs, in the
order of a hash, a parameter; everything is DataFrame and SQL work.

A null URL, or one without "://", has an empty host and path and is allowed. Without
labelled URLs everything is allowed; if all labels agree, so does every verdict. Of rules
of equal length the first in text order wins. Repeated rows are judged alike. Other
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.common import stored

SAMPLE = 20_000
TREES = 12
DEPTH = 4
SMOOTH = 5.0  # labelled URLs that a suffix's block share is drawn to the mean by


@dataclass(frozen=True)
class Rule:
    verdict: str
    where: str  # host and the start of the path, like "example.net/en/"

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        return self.where[len(self.host) :]


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path and query of every page."""
    rest = "IF(contains(url, '://'), substr(url, locate('://', url) + 3), '')"
    cut = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).withColumn("rest", F.expr(rest))
    named = cut.withColumn("name", F.regexp_extract("rest", "^[^/?#]*", 0)).withColumn("after", F.expr("substr(rest, length(name) + 1)"))
    return named.select(
        "page_id", "url", F.translate("name", _UPPER, _LOWER).alias("host"),
        F.regexp_extract("after", "^[^?#]*", 0).alias("path"),
        F.regexp_extract("after", r"^[^?#]*\?([^#]*)", 1).alias("query"),
    )


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds the longest rule that fits host and path, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.where), r.where), reverse=True):
        host = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        fits = host & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.where).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("told", verdict)


_ENTROPY = """IF(length(url) = 0, 0D, log2(length(url)) - aggregate(
    transform(array_distinct(split(url, '')), c -> CAST(length(url) - length(replace(url, c, '')) AS DOUBLE)),
    0D, (a, n) -> a + IF(n > 0, n * log2(n), 0D)) / length(url))"""
LEXICAL = {
    "f_length": "length(url)",
    "f_host_length": "length(host)",
    "f_depth": "size(filter(split(path, '/'), s -> s != ''))",
    "f_digits": "length(regexp_replace(url, '[^0-9]', '')) / greatest(length(url), 1)",
    "f_entropy": _ENTROPY,
    "f_parameters": "IF(query = '', 0, size(split(query, '&')))",
    "f_query_length": "length(query)",
    "f_labels": "size(split(host, '[.]'))",
    "f_hyphens": "length(url) - length(replace(url, '-', ''))",
    "f_longest": "array_max(transform(split(path, '[/._-]'), s -> length(s)))",
    "f_secure": "IF(startswith(lower(url), 'https:'), 1, 0)",
}
SUFFIXES = {"s1": "substring_index(host, '.', -1)", "s2": "substring_index(host, '.', -2)"}


def featured(pages: DataFrame) -> DataFrame:
    told = [F.expr(f"CAST({sql} AS DOUBLE) AS {name}") for name, sql in LEXICAL.items()]
    return pages.select("*", *told, *[F.expr(f"{sql} AS {name}") for name, sql in SUFFIXES.items()])


def with_suffixes(pages: DataFrame, labelled: DataFrame, mean: float) -> DataFrame:
    """Adds the count and the smoothed block share of labelled URLs for each suffix."""
    for s in SUFFIXES:
        stats = labelled.groupBy(s).agg(F.count(F.lit(1)).alias("__n"), F.sum("label").alias("__y"))
        pages = pages.join(stats, s, "left").withColumns({
            f"f_{s}_count": F.log1p(F.coalesce("__n", F.lit(0)).cast("double")),
            f"f_{s}_share": (F.coalesce("__y", F.lit(0.0)) + SMOOTH * mean) / (F.coalesce("__n", F.lit(0)) + SMOOTH),
        }).drop("__n", "__y")
    return pages


FEATURES = [*LEXICAL, *[f"f_{s}_{k}" for s in SUFFIXES for k in ("count", "share")]]


def verdicts(pages: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE, trees: int = TREES) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' probability to block."""
    judged = featured(with_rule(parts(pages), rules)).withColumn("label", (F.col("told") == "block").cast("double"))
    labelled = stored(judged.filter("label IS NOT NULL").select("page_id", "url", *LEXICAL, *SUFFIXES, "label"), "labelled-urls")
    n, blocked = labelled.agg(F.count(F.lit(1)), F.sum("label")).first()
    columns = ["page_id", "host", "path", "rule"]
    if not n or blocked in (0, n):
        p = F.lit(1.0 if n and blocked else 0.0)
        scored = judged.withColumn("p_block", p)
    else:
        mean = blocked / n
        picked = labelled.orderBy(F.xxhash64("url", "page_id"), "url", "page_id").limit(sample)
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        train = stored(assemble.transform(with_suffixes(picked, labelled, mean)).select("features", "label"), "url-sample")
        gbt = GBTClassifier(maxIter=trees, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=7, checkpointInterval=-1)
        model = gbt.fit(train.coalesce(2))
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(assemble.transform(with_suffixes(judged, labelled, mean)))
        scored = scored.withColumn("p_block", vector_to_array("probability")[1])
    own = F.when((F.col("host") != "") & (F.col("p_block") >= 0.5), "block").otherwise("allow")
    return scored.select(*columns, F.coalesce("told", own).alias("verdict"), F.round("p_block", 6).alias("p_block"))
