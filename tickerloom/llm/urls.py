"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule has a host, a path beginning and a verdict. It fits a URL if the URL's host is
the rule's or a subdomain of it and the path starts with the rule's; the longest rule
that fits decides. URLs with a rule are the labelled ones: boosted trees learn from
them how blocked URLs look (length, depth, digits, entropy, parameters, statistics of
the suffix) and judge those without a rule.

Rules are a handful of literals, so they become one expression. Features are SQL
functions; the trees are Spark's own and train on all labelled rows, or on about
`at_most` of them chosen by hash. Statistics of a suffix (the last two labels of the
host) are counts over all rows, joined by suffix.

Defined results: a null URL or one without `://` has an empty host and path, no rule,
and is judged by its features like others. Repeated rows are each judged. Without
labelled rows of both verdicts the rest gets the only verdict seen, or allow. Other
columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import saved

FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digits",
            "digit_ratio", "entropy", "parameters", "fragment", "secure", "hyphens",
            "longest_part", "suffix_share", "suffix_hosts"]


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")),
                  F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`urls` (with a column url) and host, path, rule, rule_verdict."""
    host, path = host_and_path(F.col("url"))
    found = urls.withColumn("host", host).withColumn("path", path)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):     # the longest comes last
        fits = (((F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host)))
                & F.startswith("path", F.lit(rule.path)))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return found.withColumn("rule", name).withColumn("rule_verdict", verdict)


def lexical(urls: DataFrame) -> DataFrame:
    """`urls` and the lexical features of url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    counts = F.expr("""transform(array_distinct(split(_url, '')),
                       c -> (length(_url) - length(replace(_url, c, ''))) / length(_url))""")
    parts = F.split(F.col("path"), "/")
    return (
        urls.withColumn("_url", url)
        .withColumn("suffix", F.substring_index("host", ".", -2))
        .withColumns({
            "url_length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": F.size(F.filter(parts, lambda x: F.length(x) > 0)).cast("double"),
            "labels": F.size(F.split(F.col("host"), r"\.")).cast("double"),
            "digits": digits.cast("double"),
            "digit_ratio": F.coalesce(F.try_divide(digits, F.length(url)), F.lit(0.0)),
            "entropy": F.when(F.length(url) > 0, F.aggregate(
                F.filter(counts, lambda p: p > 0), F.lit(0.0),
                lambda total, p: total - p * F.log2(p))).otherwise(0.0),
            "parameters": F.when(F.length(query) > 0, F.size(F.split(query, "[&;]")))
            .otherwise(0).cast("double"),
            "fragment": F.contains(url, F.lit("#")).cast("double"),
            "secure": F.startswith(F.lower(url), F.lit("https:")).cast("double"),
            "hyphens": F.length(F.regexp_replace(url, "[^-_]", "")).cast("double"),
            "longest_part": F.coalesce(F.array_max(F.transform(parts, F.length)), F.lit(0))
            .cast("double"),
        }).drop("_url"))


def with_suffix_statistics(urls: DataFrame) -> DataFrame:
    """Adds, per suffix, its share of all rows and its number of hosts. Labels are left
    out of it: rules name suffixes, so they would drown what URLs look like."""
    per_host = urls.groupBy("suffix", "host").agg(F.count("*").alias("n"))
    per_suffix = per_host.groupBy("suffix").agg(
        F.sum("n").alias("n"), F.count("*").alias("hosts"))
    total = per_suffix.agg(F.sum("n").alias("n")).first()["n"] or 1
    return urls.join(per_suffix.select(
        "suffix", (F.col("n") / total).alias("suffix_share"),
        F.log1p("hosts").alias("suffix_hosts")), "suffix")


def judge(urls: DataFrame, rules: tuple[Rule, ...] = RULES, at_most: int = 200_000,
          trees: int = 8, depth: int = 4, seed: int = 7) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of (page_id, url)."""
    plain = ruled(urls.select("page_id", "url"), rules)
    described = saved(with_suffix_statistics(lexical(plain)), "url-features")
    known = described.where("rule_verdict is not null")
    counts = {r["rule_verdict"]: r["n"] for r in
              known.groupBy("rule_verdict").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        only = F.lit(next(iter(counts), "allow"))
        return described.select("page_id", "host", "path", "rule",
                                F.coalesce("rule_verdict", only).alias("verdict"))
    share = min(1.0, at_most / sum(counts.values()))
    sample = known.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(10**6)) < int(share * 10**6))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    labelled = vectors.transform(sample).select(
        "features", (F.col("rule_verdict") == "block").cast("double").alias("label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3,
                          seed=seed).fit(saved(labelled, "url-labelled"))
    judged = model.transform(vectors.transform(described))
    learned = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", learned).alias("verdict"))
