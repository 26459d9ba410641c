"""URL verdicts: rules first, else gradient-boosted trees on lexical features."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import stored

EXAMPLES = 20_000
TREES = 20
DEPTH = 4
SEED = 7
MAX_RULES = 1_000

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEXICAL = [
    "url_length",
    "host_length",
    "host_labels",
    "path_depth",
    "digit_ratio",
    "entropy",
    "parameters",
    "hyphens",
    "has_fragment",
]
SUFFIXES = {"suffix": 1, "domain": 2}
FEATURES = LEXICAL + [f"{name}_{x}" for name in SUFFIXES for x in ("rate", "share")]


def parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` (A-Z in lower case) and ``path``; both empty without ``://``."""
    plain = F.coalesce(F.col(url), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return urls.withColumns(
        {
            "host": F.translate(F.regexp_extract(plain, URL, 1), upper, lower),
            "path": F.regexp_extract(plain, URL, 2),
        }
    )


def apply_rules(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``urls`` (with host and path) with ``rule`` and ``decided``, the longest rule that fits.

    A rule is a verdict and a host followed by a path, such as ``("block", "net/")``. It fits
    its host and that host's subdomains. Of the same rule given twice the first counts. At most
    ``MAX_RULES``, since they become one expression.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last condition put around the others is tested first: the longest rule.
    for verdict, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits &= F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        decided = F.when(fits, F.lit(verdict)).otherwise(decided)
    return urls.withColumns({"rule": rule, "decided": decided})


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` (with host and path) with the lexical features and the host's suffixes."""
    plain = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.length(plain), F.lit(1))
    letters = F.filter(F.split(plain, ""), lambda x: x != "")
    counts = F.transform(
        F.array_distinct(letters), lambda x: F.size(letters) - F.size(F.array_remove(letters, x))
    )
    entropy = F.aggregate(
        counts,
        F.lit(0.0),
        lambda total, c: total - c / n * F.log2(c / n),
    )
    count = lambda pattern: F.regexp_count(plain, F.lit(pattern)).cast("double")
    labels = F.split(F.col("host"), r"\.")
    return urls.withColumns(
        {
            "url_length": F.length(plain).cast("double"),
            "host_length": F.length("host").cast("double"),
            "host_labels": F.size(labels).cast("double"),
            "path_depth": (F.length("path") - F.length(F.replace("path", F.lit("/")))).cast("double"),
            "digit_ratio": count("[0-9]") / n,
            "entropy": entropy,
            "parameters": count(r"[?&][^?&#=]+="),
            "hyphens": count("-"),
            "has_fragment": F.contains(plain, F.lit("#")).cast("double"),
        }
        | {name: F.substring_index("host", ".", -k) for name, k in SUFFIXES.items()}
    )


def suffix_statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    """Per suffix of the host, the share of labelled URLs it has and the rate of blocked ones."""
    total = labelled.count()
    found = {}
    for name in SUFFIXES:
        sums = labelled.groupBy(name).agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))
        found[name] = stored(
            sums.select(
                F.col(name).alias(f"_{name}"),
                ((F.col("blocked") + 1) / (F.col("n") + 2)).alias(f"{name}_rate"),
                (F.col("n") / F.lit(max(total, 1))).alias(f"{name}_share"),
            ),
            "suffixes",
        )
    return found


def with_statistics(urls: DataFrame, statistics: dict[str, DataFrame]) -> DataFrame:
    for name, sums in statistics.items():
        urls = urls.join(sums, urls[name] == sums[f"_{name}"], "left").drop(f"_{name}")
        urls = urls.fillna({f"{name}_rate": 0.5, f"{name}_share": 0.0})
    return urls


def fit(labelled: DataFrame, examples: int = EXAMPLES, seed: int = SEED) -> GBTClassificationModel:
    """Trees fitted to at most ``examples`` rows, the first by a hash of the URL."""
    rows = labelled.select(*FEATURES, F.col("label").cast("double").alias("label"), F.xxhash64("url").alias("order"))
    rows = stored(rows.orderBy("order", *FEATURES).limit(examples), "examples")
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, labelCol="label", featuresCol="features")
    return trees.fit(data.select("features", "label"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``.

    The URLs that a rule decides are the labelled ones: the trees learn from them, and give the
    verdict on the others (block from a probability of 0.5). ``score`` is the probability of
    block for every URL. If the rules decide no URL, or all in one way, there is nothing to
    learn: the others get that verdict, or ``default``, and the score 1 or 0. Null URLs have
    an empty host and path and are judged by their features like any other. Other columns are
    not read; an empty table gives an empty table.
    """
    urls = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"))
    urls = lexical(apply_rules(parts(urls), rules))
    labelled = urls.where("decided IS NOT NULL").withColumn("label", (F.col("decided") == "block").cast("int"))
    kinds = [r.label for r in labelled.groupBy("label").agg(F.count("*")).collect()]
    columns = ["page_id", "host", "path", "rule", "verdict", "score"]
    if len(kinds) < 2:
        verdict = {0: "allow", 1: "block"}[kinds[0]] if kinds else default
        verdict = F.coalesce("decided", F.lit(verdict))
        return urls.withColumns({"verdict": verdict, "score": (verdict == "block").cast("double")}).select(columns)
    statistics = suffix_statistics(labelled)
    model = fit(with_statistics(labelled, statistics))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_statistics(urls, statistics))
    scored = model.transform(data).withColumn("score", vector_to_array("probability")[1])
    learnt = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("decided", learnt)).select(columns)
