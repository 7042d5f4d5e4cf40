"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

DataFrame functions and Spark's own tree learner only; no Python runs on executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, lower_ascii

#: Rows of the labelled sample that the trees and the suffix statistics are fitted on.
MAX_TRAIN_ROWS = 20_000
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789-."
LEXICAL = ["url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "hyphens", "params", "entropy", "longest_label", "vowel_ratio"]
SUFFIX = ["rate1", "seen1", "rate2", "seen2"]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule string, action) of the longest rule that fits; rules are (action, host, path)."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, action = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(df: DataFrame, url: Column) -> DataFrame:
    """Add the columns of ``LEXICAL`` and the host's last one and two labels, ``suffix1`` and ``suffix2``."""
    df = df.withColumns({"f_url": F.coalesce(url, F.lit("")), "f_host": host_of(url), "f_path": path_of(url)})
    u, h, p = F.col("f_url"), F.col("f_host"), F.col("f_path")
    n = F.greatest(F.length(h), F.lit(1)).cast("double")
    shares = F.transform(F.array(*map(F.lit, SYMBOLS)), lambda c: (F.length(h) - F.length(F.replace(h, c))) / n)
    return df.withColumns(
        {
            "url_length": F.length(u).cast("double"),
            "host_length": F.length(h).cast("double"),
            "path_length": F.length(p).cast("double"),
            "host_depth": _count(h, r"\."),
            "path_depth": _count(p, "/"),
            "digit_ratio": _count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1)),
            "hyphens": _count(h, "-"),
            "params": _count(u, "[?&][^=&#]+="),
            "entropy": F.aggregate(shares, F.lit(0.0), lambda a, x: a - F.when(x > 0, x * F.log2(x)).otherwise(0.0)),
            "longest_label": F.coalesce(F.array_max(F.transform(F.split(h, r"\."), F.length)), F.lit(0)).cast("double"),
            "vowel_ratio": _count(h, "[aeiou]") / n,
            "suffix1": F.substring_index(h, ".", -1),
            "suffix2": F.substring_index(h, ".", -2),
        }
    )


def _suffix_stats(train: DataFrame, k: int) -> DataFrame:
    return train.groupBy(f"suffix{k}").agg(F.sum("label").alias(f"bad{k}"), F.count("*").alias(f"n{k}"))


def _with_stats(df: DataFrame, stats: list[DataFrame], prior: float, own: bool) -> DataFrame:
    """Smoothed share of bad URLs per suffix; ``own``: without the row's own label, as for training rows.

    ``stats`` have a row per suffix of the bounded sample, so MAX_TRAIN_ROWS bounds the broadcast.
    """
    for k, s in enumerate(stats, 1):
        mine, one = (F.col("label"), F.lit(1)) if own else (F.lit(0.0), F.lit(0))
        df = df.join(F.broadcast(s), f"suffix{k}", "left")
        bad, n = F.coalesce(F.col(f"bad{k}") - mine, F.lit(0.0)), F.coalesce(F.col(f"n{k}") - one, F.lit(0))
        df = df.withColumns({f"rate{k}": (bad + 5 * prior) / (n + 5), f"seen{k}": F.log1p(n.cast("double"))}).drop(f"bad{k}", f"n{k}")
    return df


class UrlModel:
    """Trees plus the suffix statistics that they were trained with."""

    def __init__(self, trees: GBTClassificationModel | None, stats: list[DataFrame], prior: float):
        self.trees, self.stats, self.prior = trees, stats, prior

    def score(self, df: DataFrame, url: Column) -> DataFrame:
        """Add ``block_score`` in 0..1; the prior where there is no tree."""
        df = df.drop("block_score")
        if self.trees is None:
            return df.withColumn("block_score", F.lit(float(self.prior)))
        # the caller's columns go through as one, so that none of them meets a work column
        rows = df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("__row"), url.alias("__url"))
        full = _with_stats(lexical_features(rows, F.col("__url")), self.stats, self.prior, own=False)
        scored = self.trees.transform(VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="f_vector").transform(full))
        return scored.select("__row.*", vector_to_array("probability")[1].alias("block_score"))


def train_url_model(labelled: DataFrame, *, max_rows: int = MAX_TRAIN_ROWS, rounds: int = 20, depth: int = 4) -> UrlModel:
    """Fit on (url, label 0/1); rows with a null in either are left out.

    The fit uses the ``max_rows`` rows whose URL hashes are smallest: a bounded sample
    that does not depend on row order. Without rows, or with one class only, there are no
    trees and the share of bad URLs is the score.
    """
    rows = labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("double").alias("label")).dropna()
    sample = rows.orderBy(F.xxhash64("url"), "url", "label").limit(max_rows)
    sample = checkpoint(lexical_features(sample.coalesce(1), F.col("url")))
    n, bad = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = bad / n if n else 0.0
    if not 0 < bad < n:
        return UrlModel(None, [], prior)
    stats = [_suffix_stats(sample, 1), _suffix_stats(sample, 2)]
    stats = [checkpoint(s.coalesce(1)) for s in stats]
    train = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="f_vector").transform(_with_stats(sample, stats, prior, own=True))
    gbt = GBTClassifier(featuresCol="f_vector", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=7, checkpointInterval=-1)
    return UrlModel(gbt.fit(train.select("f_vector", "label").coalesce(1)), stats, prior)


def filter_urls(df: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]], *, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """Add ``host, path, rule, block_score, verdict`` to every row.

    The longest fitting rule decides, else the model: ``block`` from ``threshold`` up. A null
    URL, or one without ``://``, has an empty host and path; repeated rows get equal verdicts; very long URLs are judged whole;
    an empty table stays empty. Columns of ``df`` with the five names added here are replaced, all others stay.
    """
    df = df.drop(*[c for c in ("host", "path", "rule", "block_score", "verdict") if c in df.columns])
    col = df[f"`{url}`"].cast("string")
    scored = model.score(df, col)
    scored = scored.withColumns({"host": host_of(F.col(f"`{url}`").cast("string")), "path": path_of(F.col(f"`{url}`").cast("string"))})
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(action, own)})
