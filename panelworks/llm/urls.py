"""URL filters: allow and block rules, and gradient-boosted trees for urls without a rule.

Lexical features are column expressions: lengths, depth, digit ratio, entropy, parameter counts,
and how often urls with the same host suffix were blocked among the labelled ones.  The trees are
trained by Spark from the labelled urls, which stay distributed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.llm.common import stage
from panelworks.session import shared_root

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Largest expected number of labelled urls the trees are trained from.
LABELLED = 200_000
TREES = 12
DEPTH = 4
# Urls without a label that a suffix's share is smoothed with.
PRIOR = 20.0

_ADDRESS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
LEXICAL = (
    "url_length",
    "host_length",
    "path_length",
    "host_labels",
    "path_depth",
    "digit_ratio",
    "symbol_ratio",
    "entropy",
    "parameters",
    "query_length",
    "has_fragment",
    "longest_label",
)
SUFFIX = ("suffix1_blocked", "suffix1_seen", "suffix2_blocked", "suffix2_seen")


@dataclass(frozen=True)
class Rule:
    """A rule ``host/path`` with its verdict; fits the host and its subdomains."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _ADDRESS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def ruling(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits."""
    n = F.length(text).cast("double")
    distinct = F.array_distinct(F.split(text, ""))
    parts = F.transform(
        F.filter(distinct, lambda c: c != ""),
        lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n,
    )
    return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    """The features named in :data:`LEXICAL`; an empty text has zeros."""
    text = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    columns = [
        F.length(text),
        F.length(host),
        F.length(path),
        F.size(labels),
        _count(path, "/"),
        _count(text, "[0-9]") / size,
        _count(text, "[-_%.=&]") / size,
        F.when(F.length(text) > 0, _entropy(text)).otherwise(0.0),
        F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0),
        F.length(query),
        text.contains("#").cast("int"),
        F.array_max(F.transform(labels, F.length)),
    ]
    return [c.cast("double").alias(name) for c, name in zip(columns, LEXICAL, strict=True)]


def suffix_statistics(labelled: DataFrame, labels: int) -> DataFrame:
    """(suffix, blocked, seen) over all labelled hosts: the smoothed share of blocked urls
    among those with the same last ``labels`` host labels, and the logarithm of their number."""
    rate = F.sum(F.col("label")) + F.lit(PRIOR / 2)
    return labelled.groupBy(F.substring_index("host", ".", -labels).alias("suffix")).agg(
        (rate / (F.count(F.lit(1)) + PRIOR)).alias("blocked"),
        F.log1p(F.count(F.lit(1)).cast("double")).alias("seen"),
    )


@dataclass
class UrlModel:
    trees: GBTClassificationModel | None  # None: all labels were the same
    suffixes: list[DataFrame]
    constant: float = 0.0

    def features(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with url, host, path) and the features of the url."""
        rows = rows.select("*", *lexical(F.col("url"), F.col("host"), F.col("path")))
        for n, table in enumerate(self.suffixes, 1):
            table = table.select(
                F.col("suffix").alias("_suffix"),
                F.col("blocked").alias(f"suffix{n}_blocked"),
                F.col("seen").alias(f"suffix{n}_seen"),
            )
            rows = rows.join(table, F.substring_index("host", ".", -n) == F.col("_suffix"), "left")
            rows = rows.drop("_suffix").fillna(
                {f"suffix{n}_blocked": 0.5, f"suffix{n}_seen": 0.0}
            )
        return rows

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the probability that the url is to be blocked."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.constant))
        scored = self.trees.transform(_assembled(self.features(rows)))
        return scored.select(
            *rows.columns, vector_to_array(F.col("probability"))[1].alias("score")
        )


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(rows)


def train(labelled: DataFrame, bound: int = LABELLED) -> UrlModel:
    """A model from (url, label) rows, label 1.0 for blocked urls.

    Suffix statistics count every labelled url.  If a label has more than half of ``bound``, the
    trees see those of its urls that hash low, about that many, and rare labels in full.
    """
    shared_root(labelled.sparkSession)
    rows = stage(
        labelled.where("label is not null").select(
            "url",
            F.col("label").cast("double").alias("label"),
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
        ),
        "labelled",
    )
    n, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    suffixes = [stage(suffix_statistics(rows, k), "suffixes") for k in (1, 2)]
    if n == 0 or blocked in (0, n):
        return UrlModel(None, suffixes, 1.0 if n and blocked == n else 0.0)
    model = UrlModel(None, suffixes)
    shares = [min(1.0, bound / (2 * size)) for size in (n - blocked, blocked)]
    is_blocked = F.col("label") == 1
    share = F.when(is_blocked, shares[1]).otherwise(shares[0])
    low = F.pmod(F.xxhash64("url"), F.lit(1 << 32)) < share * F.lit(1 << 32)
    learn = rows if shares == [1.0, 1.0] else rows.where(low)
    # classes weigh the same
    weight = F.when(is_blocked, n / (2 * blocked * shares[1])).otherwise(
        n / (2 * (n - blocked) * shares[0])
    )
    frame = stage(model.features(learn).withColumn("weight", weight), "features")
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=0, weightCol="weight", maxBins=32
    )
    model.trees = trees.fit(_assembled(frame))
    return model


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", keep=("page_id",)):
    """The columns ``keep`` with host, path, rule, verdict and score of every row.

    A rule decides where one fits; elsewhere the trees do, trained from the urls that rules
    decide.  Null urls and urls without ``://`` have empty host and path and go by the trees.
    Without labelled urls of both kinds everything left gets the one kind there is, or allow.
    """
    url = F.col(url_col)
    rows = pages.select(
        *[F.col(c).alias(f"kept_{c}") for c in keep],
        url.alias("url"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    ).withColumn("ruling", ruling(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("ruling.verdict") == BLOCK, 1.0).otherwise(0.0)
    decided = rows.where("ruling is not null").select("url", label.alias("label"))
    scored = train(decided).score(rows)
    return scored.select(
        *[F.col(f"kept_{c}").alias(c) for c in keep],
        "host",
        "path",
        F.col("ruling.rule").alias("rule"),
        F.coalesce(
            F.col("ruling.verdict"), F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW)
        ).alias("verdict"),
        "score",
    )
