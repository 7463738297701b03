"""URL filters: rules on host and path, and gradient-boosted trees on lexical features for all other URLs.

Labels enter the features as two rates: of the host's ending and of the path's first folder. A URL that is learnt from
gets the rates of the other folds, all are drawn to the rate of all labels by ``PRIOR`` rows, and how often an ending
occurs counts by its order of magnitude only, so that the trees see evidence for an ending, not which one it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import ascii_lower, by_name, by_place, landed

#: Endings and folders are counted in so many hash buckets each, so a table of rates has at most as many rows (3 MB).
BUCKETS = 1 << 17
FOLDS = 5
PRIOR = 20.0
FEATURES = [
    "length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "entropy", "parameters", "hyphens", "suffix_size", "suffix_block_rate", "segment_block_rate",
]


@dataclass(frozen=True)
class Rule:
    """``path`` begins with a slash; the rule reads ``host`` + ``path``, like ``example.net/en/``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.lit(2**31 - 1))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*+([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (rule, verdict), else null. The rules are arguments of the program."""

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)

    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    options = [F.when(fits(r), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered]
    return F.coalesce(*options)


def _suffix(host: Column) -> Column:
    """Bucket of the last two parts of a host."""
    return F.pmod(F.xxhash64(F.regexp_extract(host, r"[^.]*\.?[^.]*$", 0)), F.lit(BUCKETS)).cast("int")


def _segment(path: Column) -> Column:
    """Bucket of the first folder of a path, an empty one where there is none."""
    return F.pmod(F.xxhash64(F.regexp_extract(path, r"^/([^/]*)/", 1)), F.lit(BUCKETS)).cast("int")


def _fold(url: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(salt)), F.lit(FOLDS)).cast("int")


def _lexical(urls: DataFrame, url: Column) -> DataFrame:
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.char_length(u), F.lit(1)).cast("double")
    share = lambda c: (F.char_length(u) - F.char_length(F.replace(u, c, F.lit("")))) / n
    letters = F.array_remove(F.array_distinct(F.split(u, "")), "")
    host, path = F.col("host"), F.col("path")
    digits = F.char_length(u) - F.char_length(F.regexp_replace(u, "[0-9]", ""))
    values = {
        "length": F.char_length(u),
        "host_length": F.char_length(host),
        "path_length": F.char_length(path),
        "host_depth": F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit(""))),
        "path_depth": F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit(""))),
        "digit_ratio": digits / n,
        "entropy": F.aggregate(letters, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c))),
        "parameters": F.size(F.array_remove(F.split(F.regexp_extract(u, r"\?([^#]*)", 1), "&"), "")),
        "hyphens": F.char_length(host) - F.char_length(F.replace(host, F.lit("-"), F.lit(""))),
    }
    return urls.select("*", *[v.cast("double").alias(f"_{k}") for k, v in values.items()], _suffix(host).alias("_suffix"), _segment(path).alias("_segment"))


@dataclass(frozen=True)
class UrlModel:
    suffixes: DataFrame
    segments: DataFrame
    rate: float
    trees: PipelineModel | None
    constant: float


def _evidence(known: DataFrame, bucket: Column, name: str) -> DataFrame:
    """URLs, labelled ones and blocked ones per bucket, the latter two by fold as well."""
    labelled, blocked = F.col("_label").isNotNull().cast("double"), F.coalesce("_label", F.lit(0.0))
    by_fold = lambda v: F.array(*[F.sum(F.when(F.col("_fold") == k, v).otherwise(0.0)) for k in range(FOLDS)])
    counted = known.groupBy(bucket.alias(name)).agg(
        F.count("*").alias("_rows"), F.sum(labelled).alias("_n"), F.sum(blocked).alias("_ones"), by_fold(labelled).alias("_n_by"), by_fold(blocked).alias("_ones_by"),
    )
    return landed(counted, f"url{name.replace('_', '-')}")


def _featured(urls: DataFrame, model: UrlModel, out_of_fold: bool = False) -> DataFrame:
    """Lexical features and the rates of ending and folder, without the row's own fold if asked for."""
    for name, table in (("_suffix", model.suffixes), ("_segment", model.segments)):
        n, ones = F.col("_n"), F.col("_ones")
        if out_of_fold:
            table = table.withColumn("_fold", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1))))
            n, ones = n - F.get("_n_by", F.col("_fold")), ones - F.get("_ones_by", F.col("_fold"))
        rate = ((ones + PRIOR * model.rate) / (n + PRIOR)).alias(f"{name}_block_rate")
        size = F.floor(F.log10("_rows")).cast("double").alias(f"{name}_size")
        on = [name, "_fold"] if out_of_fold else [name]
        # BUCKETS rows at most, FOLDS times as many for the sample that is learnt from.
        urls = urls.join(F.broadcast(table.select(*on, rate, size)), on, "left")
        urls = urls.fillna(0.0, [f"{name}_size"]).fillna(model.rate, [f"{name}_block_rate"])
    return urls


def fit_urls(
    urls: DataFrame, url: str, label: Column, sample_rows: int = 5_000, rounds: int = 8, depth: int = 3, seed: int = 7
) -> UrlModel:
    """Trees fitted on about ``sample_rows`` labelled URLs at most, taken by a hash of the URL.

    ``label`` is 1 (block), 0 (allow) or null over the columns of ``urls``, host and path. Endings and folders count
    all URLs and all labels. With labels of one class only the model is that class, without labels it allows.
    """
    host, path = parsed(F.col(url))
    known = urls.select(F.col(url).alias("_url"), host.alias("host"), path.alias("path")).select("*", label.cast("double").alias("_label"))
    known = known.withColumn("_fold", _fold(F.coalesce("_url", F.lit("")), 3))
    suffixes = _evidence(known, _suffix(F.col("host")), "_suffix")
    segments = _evidence(known, _segment(F.col("path")), "_segment")
    labelled, ones = suffixes.agg(F.coalesce(F.sum("_n"), F.lit(0.0)), F.coalesce(F.sum("_ones"), F.lit(0.0))).first()
    model = UrlModel(suffixes, segments, ones / labelled if labelled else 0.5, None, 1.0 if ones else 0.0)
    if ones in (0, labelled):
        return model
    share = min(1.0, sample_rows / labelled)
    sample = known.where(F.col("_label").isNotNull() & (F.pmod(F.xxhash64("_url"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))))
    ready = _featured(_lexical(sample, F.col("_url")), model, out_of_fold=True)
    assembler = VectorAssembler(inputCols=[f"_{f}" for f in FEATURES], outputCol="_features")
    train = assembler.transform(ready).select("_features", "_label").repartition(4).cache()
    try:
        if train.select("_label").distinct().count() < 2:
            return replace(model, constant=1.0 if 2 * ones > labelled else 0.0)
        trees = GBTClassifier(
            featuresCol="_features", labelCol="_label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32,
        )
        trees = trees.setProbabilityCol("_probability").setRawPredictionCol("_raw").setPredictionCol("_predicted")
        return replace(model, trees=PipelineModel([assembler, trees.fit(train)]))
    finally:
        train.unpersist()


def held_out_auc(urls: DataFrame, url: str, label: Column, on: Column | None = None, **fit) -> float:
    """Area under the ROC curve on a fifth of the labelled URLs, by a hash of the URL, that the model has not seen.

    ``on`` narrows the URLs that are measured, over host and path, say to one host. 0.5 where the labels there are all alike.
    """
    apart = _fold(F.coalesce(F.col(url), F.lit("")), 5) == 0
    model = fit_urls(urls, url, F.when(~_fold(F.coalesce("_url", F.lit("")), 5).eqNullSafe(0), label), **fit)
    host, path = parsed(F.col(url))
    judged = judge_urls(urls.where(apart).select(url), url, [], model)
    judged = judged.select("p_block", host.alias("host"), path.alias("path"))
    measured = judged.where(F.lit(True) if on is None else on).select("p_block", label.cast("double").alias("label")).where("label is not null")
    if measured.select("label").distinct().count() < 2:
        return 0.5
    return BinaryClassificationEvaluator(rawPredictionCol="p_block", labelCol="label", metricName="areaUnderROC").evaluate(measured)


def judge_urls(urls: DataFrame, url: str, rules: Sequence[Rule], model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """``urls`` with host, path, rule, verdict (allow or block) and ``p_block``.

    The longest fitting rule decides; a rule fits its host and all subdomains if the path begins with the rule's.
    Elsewhere the model decides. A null URL has empty host and path and is judged by the model like any other.
    Rows are judged one by one, repeated ones too; other columns pass through, whatever their names, but those
    named like a new one are replaced. An empty table gives an empty one.
    """
    placed, (own_url,) = by_place(urls, url)
    return by_name(_judged(placed, own_url, rules, model, threshold), urls.columns, "host", "path", "rule", "verdict", "p_block")


def _judged(urls: DataFrame, url: str, rules: Sequence[Rule], model: UrlModel, threshold: float) -> DataFrame:
    kept = urls.columns
    host, path = parsed(F.col(url))
    split = urls.select(*kept, host.alias("host"), path.alias("path"))
    split = split.withColumn("_ruled", ruled(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("struct<rule:string,verdict:string>"))
    if model.trees is None:
        scored = split.withColumn("p_block", F.lit(model.constant))
    else:
        scored = model.trees.transform(_featured(_lexical(split, F.col(url)), model))
        scored = scored.withColumn("p_block", vector_to_array("_probability")[1])
    own = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return scored.select(*kept, "host", "path", F.col("_ruled.rule").alias("rule"), F.coalesce("_ruled.verdict", own).alias("verdict"), "p_block")


def label_by_rules(rules: Sequence[Rule]) -> Column:
    """1 where a blocking rule wins, 0 where an allowing one does, else null; over columns host and path."""
    verdict = ruled(F.col("host"), F.col("path"), rules)["verdict"]
    return reduce(lambda acc, v: acc.when(verdict == v[0], v[1]), [("allow", 0.0)], F.when(verdict == "block", 1.0))
