"""URL filter: rules first, then gradient-boosted trees on lexical features.

URLs that a rule decides are the labelled ones; the trees are trained on them
and judge the rest. Features: lengths, depth, digit ratio, entropy, counts of
parameters and signs, and statistics of the host's suffix over all labelled URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

#: Labelled rows to train the trees on, at most (the lowest hashes of URL and id).
MAX_LABELLED = 20_000
#: Weight of the overall share in a suffix's share of blocked URLs.
PRIOR = 20
FEATURES = ["url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "entropy", "parameters",
            "hyphens", "fragment", "secure", "longest_part", "suffix_length", "suffix_blocked"]


#: SQL: the last label of the host.
SUFFIX = "element_at(split(host, '[.]'), -1)"


def split_url(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    rest = f"IF(locate('://', `{url}`) > 0, substring(`{url}`, locate('://', `{url}`) + 3), '')"
    return urls.withColumn("__rest", F.expr(f"coalesce({rest}, '')")).withColumn(
        "host", F.translate(F.regexp_extract("__rest", r"^([^/?#]*)", 1),
                            "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn(
        "path", F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1)).drop("__rest")


def apply_rules(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Add ``rule`` and ``ruled`` (its verdict), null where no rule fits.

    A rule is a verdict and host + path like ``example.com/en/``; it fits its
    host and all subdomains when the path starts with the rule's. The longest
    fitting rule wins, between equals the one given first.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("ruled", verdict)


def features(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add the lexical features that do not depend on the sample, and the host's ``suffix``."""
    u = f"coalesce(`{url}`, '')"
    entropy = ("-aggregate(transform(array_distinct({0}), c -> size(filter({0}, d -> d = c)) / size({0})), "
               "cast(0 AS double), (s, p) -> s + p * log2(p))").format("__chars")
    made = {
        "url_length": f"length({u})", "host_length": "length(host)", "path_length": "length(path)",
        "labels": "size(split(host, '[.]'))", "depth": "size(filter(split(path, '/'), x -> x <> ''))",
        "digit_ratio": f"length(regexp_replace({u}, '[^0-9]', '')) / greatest(length({u}), 1)",
        "entropy": f"IF(length({u}) = 0, 0, {entropy})",
        "parameters": f"IF(locate('?', {u}) > 0, 1 + length({u}) - length(replace({u}, '&', '')), 0)",
        "hyphens": f"length({u}) - length(replace(replace({u}, '-', ''), '_', ''))",
        "fragment": f"int(locate('#', {u}) > 0)", "secure": f"int(startswith({u}, 'https:'))",
        "longest_part": "array_max(transform(split(concat(host, path), '[./]'), x -> length(x)))",
        "suffix_length": "length(suffix)",
    }
    out = urls.withColumn("suffix", F.expr(SUFFIX)).withColumn(
        "__chars", F.expr(f"filter(split({u}, ''), x -> x <> '')"))
    return out.select("*", *[F.expr(e).cast("double").alias(n) for n, e in made.items()]).drop("__chars")


def judge_urls(urls: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url: str = "url",
               trees: int = 10, depth: int = 4) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``).

    Null and empty URLs, and those without ``://``, have an empty host and
    path, fit no rule and are judged by the trees. Where the labelled URLs
    are of one verdict, that is everyone's; without any, ``allow``. Rows are
    independent; repeated rows repeat their results.
    """
    ruled = apply_rules(split_url(urls.select(id_col, url), url), rules)
    labelled = ruled.where("ruled IS NOT NULL").withColumn("label", F.expr("double(ruled = 'block')"))
    # a labelled host ends with that of its rule, so at most one row for each rule
    counts = keep(labelled.withColumn("suffix", F.expr(SUFFIX)).groupBy("suffix").agg(
        F.count("*").alias("n"), F.sum("label").alias("blocked")), "url-suffix")
    total, blocked = counts.agg(F.sum("n"), F.sum("blocked")).first()
    if not total or blocked in (0, total):
        verdict = F.lit("block" if total and blocked == total else "allow")
        return ruled.select(id_col, "host", "path", "rule", F.coalesce("ruled", verdict).alias("verdict"))
    share = blocked / total
    suffixes = F.broadcast(counts.select("suffix", (
        (F.col("blocked") + F.lit(PRIOR * share)) / (F.col("n") + F.lit(PRIOR))).alias("suffix_blocked")))
    # by URL and id, so that the rows of one URL do not come together
    picked = labelled.withColumn("__order", F.xxhash64(url, id_col)).orderBy("__order", url, id_col).limit(MAX_LABELLED)
    # the sample is bounded, so one partition keeps training the same on any cluster
    sample = keep(features(picked, url).coalesce(1), "url-sample")

    def ready(rows: DataFrame) -> DataFrame:
        rows = rows.join(suffixes, "suffix", "left").withColumn("suffix_blocked", F.coalesce("suffix_blocked", F.lit(share)))
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)

    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=7, checkpointInterval=-1).fit(
        ready(sample).select("features", "label"))
    judged = model.transform(ready(features(ruled, url)))
    return judged.select(id_col, "host", "path", "rule", F.coalesce(
        "ruled", F.when(F.col("prediction") == 1, "block").otherwise("allow")).alias("verdict"))
