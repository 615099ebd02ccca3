"""Verdicts on URLs: rules of hosts and paths first, boosted trees on the URL's form otherwise.

The trees see lengths, depth, digit ratios, entropy, numbers of parameters and how often URLs with
the same host suffix were blocked, never the page. They are trained from labelled URLs: those of a
table of labels, or else the URLs that a rule decides. Suffix statistics are counted over all
labelled rows; for a training URL they leave out its own fold of hosts, so that the trees cannot
read a label off them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources.staging import drop_staged, stage

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The trees are fitted on about so many labelled URLs at most, drawn by hash; all else is counted
# over all rows.
SAMPLE_URLS = 50_000
HASH_RANGE = 1 << 30
FOLDS = 5
# So many URLs of the general share are added to those of a suffix.
PRIOR_URLS = 20.0
SUFFIX_LABELS = (1, 2)

FORM = (
    "url_length host_length path_length query_length depth host_labels longest_label hyphens params "
    "fragment escapes digits host_digits path_digits entropy host_entropy path_entropy extension"
).split()
FEATURES = [*FORM, *(f"{kind}_{k}" for k in SUFFIX_LABELS for kind in ("blocked", "seen"))]


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, such as ``example.com/en/``; subdomains of the host are meant too."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]

    def fits(self, host: Column, path: Column) -> Column:
        same = (host == self.host) | host.endswith("." + self.host)
        return same & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def first_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits (equal ones: the first listed), or null.

    One expression over the rules: meant for lists that a person writes, of some hundreds.
    """
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        out = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(out)
    return out


def _entropy(text: str) -> float:
    n = len(text)
    return log2(n) - sum(c * log2(c) for c in Counter(text).values()) / n if n else 0.0


def _digits(text: str) -> float:
    return sum(map(text.count, "0123456789")) / max(1, len(text))


def form(url: str | None, host: str, path: str) -> tuple[float, ...]:
    """The features of a URL's form, in the order of ``FORM``; a null URL counts as empty."""
    url = url or ""
    rest, _, fragment = url.partition("#")
    query = rest.partition("?")[2]
    labels = host.split(".") if host else []
    last = path.rpartition("/")[2]
    return (
        float(len(url)),
        float(len(host)),
        float(len(path)),
        float(len(query)),
        float(sum(map(bool, path.split("/")))),
        float(len(labels)),
        float(max(map(len, labels), default=0)),
        float(host.count("-")),
        float(sum(map(bool, query.replace(";", "&").split("&")))),
        float(bool(fragment)),
        float(url.count("%")),
        _digits(url),
        _digits(host),
        _digits(path),
        _entropy(url),
        _entropy(host),
        _entropy(path),
        float(len(last) - last.rindex(".") - 1 if "." in last else 0),
    )


@F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in FORM]))
def form_columns(url: pd.Series, host: pd.Series, path: pd.Series) -> pd.DataFrame:
    rows = [form(*row) for row in zip(url, host, path, strict=True)]
    return pd.DataFrame(rows, columns=FORM)


def with_parts(df: DataFrame) -> DataFrame:
    """Host, path and host suffixes beside a column ``url``."""
    parts = df.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    for k in SUFFIX_LABELS:
        parts = parts.withColumn(f"suffix_{k}", F.substring_index("host", ".", -k))
    return parts


def _fold(host: str) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS))


def suffix_statistics(labelled: DataFrame, labels: int) -> DataFrame:
    """(suffix, seen, blocked): labelled URLs of each host suffix, one number for each fold.

    One row per suffix and task is shuffled, so a suffix of a third of all rows is no hot key.
    """
    folds = range(FOLDS)
    counted = labelled.groupBy(F.col(f"suffix_{labels}").alias("suffix")).agg(
        *[F.count_if(F.col("fold") == f).alias(f"seen{f}") for f in folds],
        *[F.count_if((F.col("fold") == f) & (F.col("label") == 1)).alias(f"blocked{f}") for f in folds],
    )
    return counted.select(
        F.col("suffix").alias(f"suffix_{labels}"),
        F.array(*[f"seen{f}" for f in folds]).alias("seen"),
        F.array(*[f"blocked{f}" for f in folds]).alias("blocked"),
    )


def with_features(df: DataFrame, statistics: dict[int, DataFrame], share: float, training: bool) -> DataFrame:
    """Adds the feature columns; in training a row's own fold is left out of its suffix's counts.

    Suffixes without labelled URLs get the general share and count as never seen. The tables of
    statistics are joined as Spark sees fit for their size.
    """
    for k, table in statistics.items():
        df = df.join(table, f"suffix_{k}", "left")
        for name in ("seen", "blocked"):
            total = F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)
            own = F.element_at(name, (_fold("host") + 1).cast("int")) if training else F.lit(0)
            df = df.withColumn(f"{name}_own", F.coalesce(total - own, F.lit(0)))
        df = (
            df.withColumn(f"blocked_{k}", (F.col("blocked_own") + PRIOR_URLS * share) / (F.col("seen_own") + PRIOR_URLS))
            .withColumn(f"seen_{k}", F.log1p(F.col("seen_own").cast("double")))
            .drop("seen", "blocked", "seen_own", "blocked_own")
        )
    return df.withColumn("form", form_columns("url", "host", "path")).select(
        *df.columns, *[F.col("form")[name].alias(name) for name in FORM]
    )


@dataclass(frozen=True)
class UrlModel:
    """What was learnt from labelled URLs; ``trees`` is None where they have one verdict or none."""

    trees: GBTClassificationModel | None
    statistics: dict[int, DataFrame]
    share: float
    paths: list[str]

    def scored(self, df: DataFrame) -> DataFrame:
        """Adds ``score``, the probability that a URL is to be blocked, to rows with ``url``."""
        if self.trees is None:
            return df.withColumn("score", F.lit(1.0 if self.share >= 0.5 else 0.0))
        ready = with_features(df, self.statistics, self.share, training=False)
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(ready)
        scored = self.trees.transform(assembled)
        return scored.select(*df.columns, vector_to_array("probability")[1].alias("score"))


def trained(labelled: DataFrame, sample_urls: int = SAMPLE_URLS, seed: int = 7) -> UrlModel:
    """Boosted trees from (url, label); label 1 means block. Null URLs and labels are left out.

    About ``sample_urls`` distinct URLs, drawn by a hash of the URL, go into the trees; a URL with
    both labels counts as blocked. Suffix statistics come from all rows.
    """
    spark = labelled.sparkSession
    known = with_parts(labelled.where("url IS NOT NULL AND label IS NOT NULL").select("url", "label"))
    known = known.withColumn("fold", _fold("host"))
    found = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == 1).alias("blocked"),
        F.approx_count_distinct("url", 0.02).alias("urls"),
    ).first()
    share = found.blocked / found.n if found.n else 0.0
    if not 0 < share < 1:
        return UrlModel(None, {}, share, [])
    paths = [stage(suffix_statistics(known, k), "suffixes") for k in SUFFIX_LABELS]
    statistics = {k: spark.read.parquet(path) for k, path in zip(SUFFIX_LABELS, paths, strict=True)}
    border = min(HASH_RANGE, int(HASH_RANGE * (sample_urls / max(1, found.urls))))
    drawn = (
        known.where(F.pmod(F.xxhash64("url"), F.lit(HASH_RANGE)) < border)
        .groupBy("url", "host", "path", *(f"suffix_{k}" for k in SUFFIX_LABELS))
        .agg(F.max("label").cast("double").alias("label"))
    )
    ready = with_features(drawn, statistics, share, training=True)
    # Sorted, the rows that the fit bins and adds up come in the same order whatever the tasks were.
    training = stage(ready.select("url", "label", *FEATURES).sort("url"), "urls")
    try:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(spark.read.parquet(training))
        trees = GBTClassifier(
            labelCol="label", featuresCol="features", maxIter=20, maxDepth=4, maxBins=64, stepSize=0.2,
            minInstancesPerNode=5, seed=seed,
        ).fit(rows.select("label", "features"))
    finally:
        drop_staged(spark, training)
    return UrlModel(trees, statistics, share, paths)


def url_verdicts(
    df: DataFrame,
    rules: Sequence[Rule],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, url, host, path, rule, verdict, score): what becomes of every row's URL.

    The longest rule that fits decides. Where none does, the trees block from a score of 0.5 on.
    They learn from ``labelled`` (url, label: 1 blocks), or from the rows that a rule decides.
    A null URL, or one without ``://``, has an empty host and path, fits no rule and is scored
    as it is. Without labelled URLs everything else is allowed, with labels of one kind it gets
    that verdict. Repeated rows each get theirs; an empty table gives none. Only the two named
    columns are read.
    """
    urls = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = F.col("host"), F.col("path")
    ruled = (
        with_parts(urls)
        .withColumn("rule", first_rule(rules, host, path, lambda r: r.text))
        .withColumn("ruled", first_rule(rules, host, path, lambda r: r.verdict))
    )
    if labelled is None:
        labelled = ruled.select("url", F.when(F.col("ruled") == BLOCK, 1).when(F.col("ruled") == ALLOW, 0).alias("label"))
    model = trained(labelled)
    judged = F.coalesce("ruled", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    out = model.scored(ruled).select(
        F.col("id").alias(id_col), "url", "host", "path", "rule", judged.alias("verdict"), "score"
    )
    try:
        kept = stage(out, "verdicts")
    finally:
        for staged in model.paths:
            drop_staged(df.sparkSession, staged)
    return df.sparkSession.read.parquet(kept)
