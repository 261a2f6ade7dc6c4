"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

Everything here is DataFrame functions and Spark's own learner: no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A small labelled URL table (1: to block). Hosts of the reserved example domains and plain words only.
LABELLED_URLS = [
    ("http://www.cheap-pills.example.com/en/buy", 1), ("https://cheap-pills.example.org/fr/12", 1),
    ("http://best-pills-online.example.com/en/7", 1), ("https://pharma-discount.example.net/de/3", 1),
    ("https://spam-farm.example.org/en/728", 1), ("http://m.spam-farm.example.com/es/41", 1),
    ("http://spam-links.example.net/en/5", 1), ("http://link-farm.example.com/en/66.html", 1),
    ("https://casino-royal.example.com/en/slots", 1), ("http://online-casino.example.net/de/9", 1),
    ("https://win-casino-bonus.example.org/en/1", 1), ("http://free-money.example.com/en/now", 1),
    ("http://fast-loans.example.net/en/apply", 1), ("https://payday-loans.example.org/en/2", 1),
    ("http://adult-videos.example.com/en/55", 1), ("https://xxx-adult.example.net/en/99", 1),
    ("http://hot-adult-chat.example.org/de/4", 1), ("https://replica-watches.example.com/fr/8", 1),
    ("http://free-download-crack.example.net/en/6", 1), ("https://lottery-winner.example.com/es/3", 1),
    ("http://click-here-win.example.org/en/prize", 1), ("https://betting-tips.example.net/en/12", 1),
    ("http://poker-bonus.example.com/en/31", 1), ("https://cheap-viagra.example.org/en/20", 1),
    ("http://www.example.com/en/about", 0), ("https://news.example.org/en/825", 0),
    ("https://blog.example.net/en/853/", 0), ("http://m.garden.example.com/de/640", 0),
    ("https://www.library.example.org/fr/12.html", 0), ("http://school.example.net/es/978", 0),
    ("https://weather.example.com/en/671?utm_source=feed", 0), ("http://recipes.example.org/en/453#top", 0),
    ("https://thther.example.org/en/685", 0), ("http://therha.example.com/en/676", 0),
    ("https://blog.tiontion.example.com/en/853/", 0), ("https://www.ththen.example.com/en/148.html", 0),
    ("https://tionsh.example.org/es/533/", 0), ("http://museum.example.com/fr/825?page=2&ref=x", 0),
    ("https://city-council.example.org/de/252", 0), ("http://open-data.example.net/en/3", 0),
    ("https://bird-watching.example.com/en/10", 0), ("http://history-notes.example.org/en/77", 0),
    ("https://docs.example.net/en/manual.html", 0), ("http://math-forum.example.com/en/18", 0),
    ("https://travel-diary.example.org/es/61", 0), ("http://theron.example.com/de/925#top", 0),
    ("https://ththing.example.com/en/334/", 0), ("http://www.therti.example.org/en/618/", 0),
]
#: ``url_verdict``'s default rules: what to do, and a host with the beginning of a path.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    suffix, _, start = rule.partition("/")
    own = host == suffix
    return (own | host.endswith(f".{suffix}")) & path.startswith(f"/{start}")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]], part: int) -> Column:
    """The longest rule that fits (``part`` 1) or what it says (``part`` 0); null where none fits."""
    chain = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1])):
        chain = F.when(_fits(rule[1], host, path), F.lit(rule[part])).otherwise(chain)
    return chain


def _grams(text: Column, tag: str, size: int) -> Column:
    """Runs of characters with the ends marked; the tag keeps those of hosts and paths apart."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    last = F.greatest(F.length(marked) - (size - 1), F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda k: F.concat(F.lit(tag), F.substr(marked, k, F.lit(size))))


def url_grams(host: Column, path: Column, size: int = 3) -> Column:
    return F.concat(_grams(host, "h:", size), _grams(path, "p:", size))


def fit_url_model(labelled: DataFrame, url_col: str = "url", label_col: str = "label", buckets: int = 1 << 13,
                  reg: float = 0.01) -> PipelineModel:
    """Fit on a small labelled table. Its size does not depend on what is filtered later."""
    url = F.col(f"`{url_col}`")
    rows = labelled.select(url_grams(host_of(url), path_of(url)).alias("grams"),
                           F.col(f"`{label_col}`").cast("double").alias("label"))
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True)
    learner = LogisticRegression(regParam=reg, maxIter=50, featuresCol="features", labelCol="label")
    return PipelineModel([hashing, learner.fit(hashing.transform(rows))])


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED_URLS, "url string, label int")


def url_verdicts(pages: DataFrame, model: PipelineModel, rules: Sequence[tuple[str, str]] = RULES,
                 id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """A row per page: id, host, path, rule, verdict (``block`` or ``allow``) and the model's score.

    The longest fitting rule decides, else the model: blocked at ``threshold`` or more. A null url, or
    one without ``://``, has an empty host and path and is judged by the model like any other.
    Repeated rows are judged each; an empty table gives no rows; other columns are ignored.
    """
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("grams", url_grams(F.col("host"), F.col("path")))
    host, path = F.col("host"), F.col("path")
    scored = model.transform(rows).withColumn("score", F.get(vector_to_array("probability"), 1))
    by_model = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id", "host", "path", rule_of(host, path, rules, 1).alias("rule"),
        F.coalesce(rule_of(host, path, rules, 0), by_model).alias("verdict"), F.round("score", 6).alias("score"),
    )
