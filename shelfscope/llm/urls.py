"""URL filters: longest-match rules, then logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table. Host and path are cut into
character n-grams, marked by which of the two they come from, hashed into a fixed
number of features and weighed by a logistic regression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import drop_path, fresh_path
from .frames import with_own, without

ALLOW, BLOCK = "allow", "block"
SIZES = (3, 4, 5)
FEATURES = 1 << 14
#: A labelled table larger than this is sampled, by a hash of the URL, to about this many rows.
MAX_LABELLED = 10_000
_BUCKETS = 1 << 20


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return own & F.startswith(path, F.lit(self.path))


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def char_ngrams(host: Column, path: Column) -> Column:
    """All n-grams of ``SIZES`` of host and path, each marked by its part and its ends."""

    def grams(mark: str, value: Column) -> Column:
        framed = F.concat(F.lit("^"), value, F.lit("$"))

        def of_size(n: Column) -> Column:
            places = F.sequence(F.lit(1), F.char_length(framed) - n + 1)
            return F.when(
                F.char_length(framed) >= n, F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(framed, i, n)))
            ).otherwise(F.array().cast("array<string>"))

        return F.flatten(F.transform(F.array(*map(F.lit, SIZES)), of_size))

    return F.concat(grams("h", host), grams("p", path))


def _features(df: DataFrame) -> DataFrame:
    grams = with_own(df, {"_url_grams": char_ngrams(F.col("host"), F.col("path"))})
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_url_grams", outputCol="_url_features")
    return hashing.transform(grams).drop("_url_grams")


@dataclass(frozen=True)
class UrlModel:
    """A fitted regression, or the one verdict of a table that knows no other."""

    regression: LogisticRegressionModel | None
    only: str = ALLOW

    def judge(self, df: DataFrame) -> DataFrame:
        """``df`` (with host and path) plus ``p_block`` and ``learned``."""
        if self.regression is None:
            blocked = 1.0 if self.only == BLOCK else 0.0
            return with_own(df, {"p_block": F.lit(blocked), "learned": F.lit(self.only)})
        scored = self.regression.transform(_features(without(df, ["p_block", "learned"])))
        probability = F.get(vector_to_array("_url_probability"), F.lit(1))
        return with_own(
            scored, {"p_block": probability, "learned": F.when(F.col("_url_verdict") > 0.5, BLOCK).otherwise(ALLOW)}
        ).drop("_url_features", "_url_raw", "_url_probability", "_url_verdict")


def train_url_model(labelled: DataFrame, limit: int = MAX_LABELLED) -> UrlModel:
    """Fit to rows (url, label), label being allow or block; others are left out.

    The sample of at most about ``limit`` distinct URLs is put into one partition in a
    fixed order, so the same table always gives the same model.
    """
    known = labelled.filter(F.col("label").isin(ALLOW, BLOCK) & F.col("url").isNotNull())
    one = known.groupBy("url").agg(F.max("label").alias("label"))
    counts = {row["label"]: row["count"] for row in one.groupBy("label").count().collect()}
    if len(counts) < 2:
        return UrlModel(None, next(iter(counts), ALLOW))
    share = min(1.0, limit / sum(counts.values()))
    drawn = one.filter(F.pmod(F.xxhash64("url", F.lit(29)), F.lit(_BUCKETS)) < int(share * _BUCKETS))
    rows = drawn.select(
        "url",
        (F.col("label") == BLOCK).cast("double").alias("_url_label"),
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
    )
    regression = LogisticRegression(
        featuresCol="_url_features",
        labelCol="_url_label",
        rawPredictionCol="_url_raw",
        probabilityCol="_url_probability",
        predictionCol="_url_verdict",
        maxIter=40,
        regParam=1e-3,
        standardization=False,
    )
    fitted = regression.fit(_features(rows).coalesce(1).sortWithinPartitions("url"))
    # A fitted model holds its training summary, and that the session, which tasks can't be sent.
    # One that was read back holds the coefficients only.
    path = fresh_path(labelled.sparkSession, "url-model")
    fitted.write().save(path)
    model = LogisticRegressionModel.load(path)
    drop_path(labelled.sparkSession, path)
    return UrlModel(model)


def match_rules(df: DataFrame, rules: tuple[UrlRule, ...], url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (the longest that fits, else null) and ``ruled`` (its verdict)."""
    split = with_own(df, {"_url": F.coalesce(F.col(f"`{url}`"), F.lit(""))})
    split = with_own(split, {"host": url_host(F.col("_url")), "path": url_path(F.col("_url"))}).drop("_url")
    host, path = F.col("host"), F.col("path")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        name = F.when(rule.fits(host, path), rule.name).otherwise(name)
        verdict = F.when(rule.fits(host, path), rule.verdict).otherwise(verdict)
    return with_own(split, {"rule": name, "ruled": verdict})


def filter_urls(df: DataFrame, rules: tuple[UrlRule, ...], model: UrlModel, url: str = "url") -> DataFrame:
    """``df`` with host, path, rule, p_block and ``verdict``: the rule's, else the model's.

    A null or malformed URL has an empty host and path; the model judges it. Columns of
    the same names are replaced.
    """
    judged = model.judge(match_rules(df, rules, url))
    return with_own(judged, {"verdict": F.coalesce("ruled", "learned")}).drop("ruled", "learned")
