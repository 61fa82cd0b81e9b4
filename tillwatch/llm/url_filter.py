"""URL filters: allow and block rules first, then gradient-boosted trees on lexical features.

A rule is `host/path`; it fits its host and all subdomains where the url's path starts with the rule's. The longest rule
that fits decides; of equally long ones that with the longer host, then the first in order of characters. Urls that no
rule fits are judged by trees trained on a bounded sample of labelled urls (TRAIN_ROWS of each label). The trees are turned
into conditional expressions, so scoring is plain columns.

Features: lengths, depth, digit ratio, entropy, parameter counts, host labels and hyphens, and statistics of the host's
suffix (its last two labels): how many of all urls have it, and what share of the labelled sample's urls with it is
unwanted. Suffix counts join on the suffix; where one suffix has a large share of all rows, the adaptive join splits it.

The host is what stands between the first `://` and `/`, `?`, `#` or the end, with A to Z lower-cased; the path goes on from
there to `?`, `#` or the end. Null urls and those without `://` have an empty host and path: no rule fits, and the trees judge
what is there. Repeated urls get equal verdicts; an empty table gives an empty result; other columns are carried along,
except that those named like a result are replaced. If the labels are all of one kind, every url that no rule fits is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import let, stored

#: Bound on the labelled sample: urls of each label.
TRAIN_ROWS = 5_000
TREES = 12
DEPTH = 3
CUT = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"

# The rules, and the words in a host that label a url as unwanted.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
UNWANTED = ("adult", "ads-track", "bets", "casino", "pills", "spam")

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "digit_ratio", "host_digits", "entropy", "host_entropy", "n_params",
    "param_length", "has_fragment", "host_labels", "host_hyphens", "longest_label", "suffix_count", "suffix_unwanted",
)


def _rest(url: Column) -> Column:
    """What follows the first `://`; null if there is none."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Ruling:
    """The rules as one expression; they are configuration, and each costs every url a comparison."""

    rules: dict[str, str]

    def longest(self, host: Column, path: Column) -> Column:
        found = None
        for rule in sorted(self.rules, key=lambda own: (-len(own), -own.index("/"), own)):
            at = rule.index("/")
            own_host, own_path = rule[:at], rule[at:]
            fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(own_path))
            found = F.when(fits, rule) if found is None else found.when(fits, rule)
        return F.lit(None).cast("string") if found is None else found

    def verdict(self, rule: Column) -> Column:
        found = None
        for own, verdict in self.rules.items():
            found = F.when(rule == own, verdict) if found is None else found.when(rule == own, verdict)
        return F.lit(None).cast("string") if found is None else found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    length = F.char_length(text)
    share = lambda own, letter: (F.char_length(own) - F.char_length(F.replace(own, letter, F.lit("")))) / F.char_length(own)
    return F.when(length == 0, 0.0).otherwise(let(text, lambda own: F.aggregate(
        F.transform(F.array_distinct(F.filter(F.split(own, ""), lambda letter: letter != "")), lambda letter: share(own, letter)),
        F.lit(0.0), lambda so_far, p: so_far - p * F.log2(p))))


def _digits(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, _DIGITS, ""))


def described(urls: DataFrame) -> DataFrame:
    """The rows with host, path, suffix and the features that a url has by itself."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.filter(F.split(query, "[&;]"), lambda own: own != "")
    labels = F.split("host", r"\.")
    return urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumns({
        "suffix": suffix_of(F.col("host")),
        "url_length": F.char_length(url).cast("double"),
        "host_length": F.char_length("host").cast("double"),
        "path_length": F.char_length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda own: own != "")).cast("double"),
        "digit_ratio": F.when(F.char_length(url) == 0, 0.0).otherwise(_digits(url) / F.char_length(url)),
        "host_digits": _digits(F.col("host")).cast("double"),
        "entropy": _entropy(url),
        "host_entropy": _entropy(F.col("host")),
        "n_params": F.size(parts).cast("double"),
        "param_length": F.char_length(query).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "host_labels": F.size(labels).cast("double"),
        "host_hyphens": (F.char_length("host") - F.char_length(F.translate("host", "-", ""))).cast("double"),
        "longest_label": F.array_max(F.transform(labels, lambda own: F.char_length(own))).cast("double"),
    })


def sampled(labelled: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """url and label (0 or 1) of at most `rows` different urls of each label, the same ones each time.

    A url counts once however many rows it has; one with both labels is unwanted.
    """
    known = labelled.filter("url is not null and label in (0, 1)").groupBy("url").agg(F.max("label").cast("int").alias("label"))
    chosen = None
    for label in (0, 1):
        own = known.filter(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(rows)
        chosen = own if chosen is None else chosen.union(own)
    return chosen


def suffix_of(host: Column) -> Column:
    """The last two labels of a host, or the one it has."""
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), F.lit(2)), ".")


def suffix_statistics(urls: DataFrame, sample: DataFrame) -> DataFrame:
    """Per suffix of any url: the logarithm of its count over all urls, and the smoothed unwanted share in the sample."""
    suffix = suffix_of(host_of(F.col("url"))).alias("suffix")
    counts = urls.groupBy(suffix).agg(F.log1p(F.count("*").cast("double")).alias("suffix_count"))
    taught = sample.groupBy(suffix).agg(((F.sum("label") + 1) / (F.count("*") + 2)).alias("suffix_unwanted"))
    both = counts.join(taught, "suffix", "full")
    return stored(both.na.fill({"suffix_count": 0.0, "suffix_unwanted": 0.5}), "suffixes")


def train(sample: DataFrame, suffixes: DataFrame, trees: int = TREES, depth: int = DEPTH) -> GBTClassificationModel | None:
    """Boosted trees of a bounded sample; None if its labels are all of one kind."""
    if sample.select("label").distinct().count() < 2:
        return None
    rows = described(sample).join(suffixes, "suffix").select("label", *FEATURES)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "features")
    return GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=5).fit(assembled)


def as_column(model: GBTClassificationModel) -> Column:
    """The model's probability of an unwanted url as an expression over the features."""

    def grown(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.col(FEATURES[split.featureIndex()]) <= float(split.threshold()), grown(node.leftChild())).otherwise(
            grown(node.rightChild()))

    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        margin = margin + grown(tree._call_java("rootNode")) * float(weight)
    return 1 / (1 + F.exp(-2 * margin))


def judge(urls: DataFrame, labelled: DataFrame, rules: dict[str, str] = RULES, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows with host, path, rule (or null), verdict (`allow` or `block`) and score, the trees' probability."""
    carried = [name for name in urls.columns if name not in ("host", "path", "rule", "verdict", "score")]
    packed = urls.select("url", F.struct(*[F.col(f"`{name}`") for name in carried]).alias("row"))
    sample = stored(sampled(labelled, rows).coalesce(1), "labelled-urls")
    suffixes = suffix_statistics(urls, sample)
    model = train(sample, suffixes)
    ruling = Ruling(rules)
    # Every url's suffix is in the statistics, as they are taken over all urls.
    scored = described(packed).join(suffixes, "suffix").withColumn("score", F.lit(0.0) if model is None else as_column(model))
    return scored.withColumn("rule", ruling.longest(F.col("host"), F.col("path"))).select(
        "row.*", "host", "path", "rule",
        F.coalesce(ruling.verdict(F.col("rule")), F.when(F.col("score") >= CUT, "block").otherwise("allow")).alias("verdict"), "score")


def labelled_by_host(urls: DataFrame, unwanted: Sequence[str] = UNWANTED) -> DataFrame:
    """url and label: 1 where the host holds one of the words known to be unwanted."""
    host = host_of(F.col("url"))
    bad = F.lit(False)
    for word in unwanted:
        bad = bad | F.contains(host, F.lit(word))
    return urls.select("url", bad.cast("int").alias("label"))


def report(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page's url."""
    urls = pages.select("page_id", "url")
    return judge(urls, labelled_by_host(urls)).select("page_id", "host", "path", "rule", "verdict", "score")
