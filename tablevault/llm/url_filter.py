"""URL filters: host and path rules, and logistic regression for the rest.

Everything is a DataFrame expression or aggregate. The regression works on hashed
character n-grams of host and path, in ``BUCKETS`` buckets, with counts divided by
the root of their number. It is fitted on a small labelled table by accelerated
gradient descent: a step is one aggregate by bucket, and only the ``BUCKETS``
weights pass through the driver. Scoring looks the weights up in a literal array.

A rule fits its host and all subdomains if the path starts with the rule's path;
of several the longest (host and path) wins. A null url, or one without ``://``,
has empty host and path; it fits no rule and, without n-grams, gets the verdict
of the regression's intercept. Repeated rows are each judged; other columns are
ignored; an empty table gives no rows. Rules are few: they are one expression.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.llm.common import written

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
STEPS = 30
RATE = 16.0
PENALTY = 1e-4
BLOCK_AT = 0.5
MAX_LABELLED = 8000  # rows of the labelled table that are used

# Words of hosts and paths by their label, the small labelled table's source.
BLOCK_WORDS = ("adult", "ads", "bets", "bonus", "cams", "casino", "cheap", "click", "crack", "escort", "farm", "free",
               "jackpot", "loan", "payday", "pills", "poker", "porn", "prize", "replica", "sex", "slots", "spam", "torrent",
               "track", "viagra", "warez", "win", "xxx")
ALLOW_WORDS = ("archive", "bakery", "bridge", "city", "council", "forest", "garden", "harbour", "history", "journal", "kitchen",
               "language", "library", "market", "mountain", "museum", "music", "nature", "news", "notes", "paper", "recipe",
               "river", "school", "science", "street", "teacher", "theatre", "travel", "university", "weather", "wiki")
# Hosts that stand on both sides: what is below them decides.
SHARED_HOSTS = ("pages", "web", "site", "home", "my", "portal", "online", "static")
PATH_FORMS = ("https://{h}.org/{a}/{b}", "http://www.{h}.com/{a}-{b}.html", "https://{h}.net/x/{a}?id=1", "http:///{a}/{b}")
LABELLED_FORMS = ("https://{a}-{b}.example.com/en/", "http://www.{a}{b}.example.net/page.html", "https://{a}.example.org/{b}/1",
                  "https://blog.{b}-{a}.example.org/de/")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: ``url``, ``blocked``; pairs of words of
    a list are put into the same forms for either label, four times as many to allow. In half of
    the forms the words stand in the path, below hosts that both labels share or none. A
    table of real urls with the two columns takes its place in ``fit``."""
    rows = []
    for words, blocked, pairs in ((BLOCK_WORDS, True, 2), (ALLOW_WORDS, False, 8)):
        for k, a in enumerate(words):
            for far in range(1, pairs + 1):
                b, h = words[(k + 3 * far) % len(words)], SHARED_HOSTS[(k + far) % len(SHARED_HOSTS)]
                rows += [{"url": form.format(a=a, b=b, h=h), "blocked": blocked} for form in (*LABELLED_FORMS, *PATH_FORMS)]
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<url:string,blocked:boolean>>"))
                                 .alias("r")).select("r.*")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(text, pattern, 1), upper, upper.lower()), F.regexp_extract(text, pattern, 2))


def grams(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all character n-grams of host and path; the two differ."""
    def of(salt: int, text: Column, n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        found = F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(salt), text.substr(i, F.lit(n))), F.lit(buckets)).cast("int"))
        return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<int>"))

    # without a host its marks are no text either
    whole = F.when(host != "", F.concat(F.lit("."), host, F.lit("/"))).otherwise(F.lit(""))
    return F.concat(*[of(salt, text, n) for salt, text in ((1, whole), (2, path)) for n in GRAMS])


def _margin(buckets: Column, weights: list[float], intercept: float) -> Column:
    table = F.from_json(F.lit(json.dumps([round(w, 6) for w in weights])), "array<double>")
    total = F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.coalesce(F.get(table, b), F.lit(0.0)))
    return total / F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double")) + F.lit(round(intercept, 6))


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", steps: int = STEPS) -> tuple[list[float], float]:
    """Weights by bucket and the intercept. Rows without url or label are left out;
    of more than ``MAX_LABELLED`` rows those with the smallest hashes are used. No
    rows give a model that blocks nothing."""
    rows = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).select(
        *(c.alias(n) for n, c in zip(("host", "path"), host_and_path(F.col(url_col)))), F.col(label_col).cast("boolean").cast("double").alias("y"))
    rows = rows.orderBy(F.xxhash64("host", "path", "y"), "host", "path", "y").limit(MAX_LABELLED)
    rows = written(rows.select(grams(F.col("host"), F.col("path")).alias("b"), "y"), "labelled")
    n = rows.count()
    weights, intercept = [0.0] * BUCKETS, 0.0
    if not n:
        return weights, -20.0
    ahead, ahead_0 = list(weights), intercept
    for step in range(steps):
        error = F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(F.col("b"), ahead, ahead_0))) - F.col("y")
        part = rows.select("b", error.alias("e"))
        each = part.select(F.explode(F.concat(F.col("b"), F.array(F.lit(-1)))).alias("k"), (F.when(F.size("b") > 0, F.col("e") / F.sqrt(F.size("b").cast("double")))
                                                                                          .otherwise(0.0)).alias("g"), "e")
        slope = {r["k"]: r for r in each.groupBy("k").agg(F.sum("g").alias("g"), F.sum("e").alias("e")).collect()}  # BUCKETS + 1 rows at most
        new = [a - RATE * ((slope[k]["g"] / n if k in slope else 0.0) + PENALTY * a) for k, a in enumerate(ahead)]
        new_0 = ahead_0 - RATE / 2 * slope[-1]["e"] / n
        push = step / (step + 3)
        ahead = [a + push * (a - b) for a, b in zip(new, weights)]
        ahead_0 = new_0 + push * (new_0 - intercept)
        weights, intercept = new, new_0
    return weights, intercept


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule ``(verdict, host, path)`` that fits, as a struct of its text
    and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], model: tuple[list[float], float], id_col: str = "page_id",
          url_col: str = "url", block_at: float = BLOCK_AT) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` of every row; ``score`` is the
    regression's probability that the url is to be blocked."""
    host, path = host_and_path(F.col(url_col))
    df = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    df = df.withColumn("_grams", grams(F.col("host"), F.col("path")))
    df = df.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_margin", _margin(F.col("_grams"), *model))
    own = F.when(F.col("_margin") >= math.log(block_at / (1 - block_at)), "block").otherwise("allow")
    return df.select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
                     F.coalesce("_rule.verdict", own).alias("verdict"),
                     (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))).alias("score"))
