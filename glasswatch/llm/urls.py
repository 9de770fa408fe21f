"""URL filter: host and path rules, and a logistic regression on hashed character n-grams for URLs that no rule fits.

The model is trained on a small labelled URL table, of which at most ``MAX_LABELS`` rows are used, lowest hash
first. Host and path are marked and cut into character n-grams; their hashes are feature indices. Spark's own estimator fits the
weights in the JVM. No Python runs on executors.

Null URLs and URLs without ``://`` have empty host and path: no rule fits them, and they are allowed. If the labels are missing or all
alike, there's no model and URLs without a rule are allowed. Repeated rows and extra columns are harmless. An empty table gives no rows;
URLs of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the training table.
MAX_LABELS = 4000
#: Wide enough that n-grams no label holds seldom share a feature with one that some label holds.
FEATURES = 1 << 16
SIZES = (3, 4)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def parsed(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fits(rule: Rule) -> Column:
    own = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
    return own & F.startswith("path", F.lit(rule.path))


def grams(text: Column, sizes: tuple[int, ...] = SIZES) -> Column:
    """All character n-grams of a text; a shorter text is its own."""
    lists = [
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i, n=n: F.substr(text, i, F.lit(n)))
        for n in sizes
    ]
    return F.concat(*lists)


def with_features(urls: DataFrame) -> DataFrame:
    marked = F.translate(F.concat(F.lit("^"), "host", F.lit("|"), "path", F.lit("$")), "123456789", "000000000")
    return HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="_features", binary=True).transform(urls.withColumn("_grams", grams(marked)))


def train(labelled: DataFrame, max_labels: int = MAX_LABELS) -> LogisticRegressionModel | None:
    """A model of ``labelled(host, path, label)``; rows beyond the bound are left out by a hash of the URL."""
    picked = labelled.select("host", "path", "label").distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_labels)
    # one partition in a fixed order, so that sums of doubles and with them the weights agree from run to run
    rows = with_features(picked.coalesce(1).sortWithinPartitions("host", "path", "label"))
    kinds = [r[0] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return None
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.01, maxIter=30, tol=1e-4).fit(rows)


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...], labelled: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """``labelled(url, label)``: 1 to allow, 0 to block. Per page: ``page_id``, ``host``, ``path``, ``rule`` (the longest that fits, or null), ``verdict`` and the model's ``score``."""
    host, path = parsed()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        rule, allow = F.when(fits(r), r.name).otherwise(rule), F.when(fits(r), F.lit(r.allow)).otherwise(allow)
    urls = urls.withColumn("rule", rule).withColumn("_allow", allow)
    known = labelled.filter("url is not null and label is not null").select(host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label"))
    model = train(known, max_labels)
    if model is None:
        scored = urls.withColumn("score", F.lit(1.0))
    else:
        scored = model.setProbabilityCol("_p").transform(with_features(urls)).withColumn("score", vector_to_array("_p")[1])
    keep = F.coalesce("_allow", (F.col("host") == "") | (F.col("score") >= 0.5))
    return scored.select("page_id", "host", "path", "rule", F.when(keep, "allow").otherwise("block").alias("verdict"), F.round("score", 6).alias("score"))
