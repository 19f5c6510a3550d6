"""URL filters: given host and path rules, and mined combinations of URL tokens.

Spark's FP-growth mines token sets from labelled URLs. Rules "tokens -> block" are
kept by support and confidence. A URL is matched through an inverted index from
token to rules: a rule fires when the URL holds as many of its tokens as it has.
Matching is done once per distinct token set, not per URL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLOCK, _ALLOW = "=block", "=allow"
MIN_SHARE = 0.002
MIN_COUNT = 50
MIN_CONFIDENCE = 0.8


def _after_scheme(url: str) -> Column:
    at = F.instr(F.col(url), F.lit("://"))
    return F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")


def host_of(url: str) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """From the end of the host up to ``?`` or ``#``; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of (host, path, verdict) that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def tokens_of(url: str) -> Column:
    """Distinct tokens: host labels and their hyphen parts, path segments with numbers as ``#``, names of parameters."""
    host = F.filter(F.split(host_of(url), r"\."), lambda t: t != "")
    parts = F.filter(F.split(host_of(url), r"[.\-]"), lambda t: t != "")
    path = F.filter(F.split(F.lower(path_of(url)), "/"), lambda t: t != "")
    query = F.filter(F.split(F.regexp_extract(_after_scheme(url), r"\?([^#]*)", 1), "&"), lambda t: t != "")
    named = [
        F.transform(host, lambda t: F.concat(F.lit("host:"), t)),
        F.transform(parts, lambda t: F.concat(F.lit("word:"), t)),
        F.transform(path, lambda t: F.concat(F.lit("path:"), F.regexp_replace(t, "[0-9]+", "#"))),
        F.transform(query, lambda t: F.concat(F.lit("key:"), F.lower(F.split(t, "=")[0]))),
    ]
    return F.array_sort(F.array_distinct(F.concat(*named)))


def mine(labelled: DataFrame, min_share: float = MIN_SHARE, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame | None:
    """(rule_id, tokens, confidence, support) from rows of (tokens, block); None without labelled rows.

    A rule's tokens and its label together occur in at least ``min_count`` rows and
    ``min_share`` of all.
    """
    n = labelled.count()
    if not n:
        return None
    items = labelled.select(F.concat("tokens", F.array(F.when(F.col("block"), _BLOCK).otherwise(_ALLOW))).alias("items"))
    support = min(1.0, max(min_share, min_count / n))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.filter(F.col("consequent") == F.array(F.lit(_BLOCK)))
    found = found.filter(~F.array_contains("antecedent", _ALLOW))
    return runtime.pin(
        found.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support").withColumn("rule_id", F.md5(F.array_join("tokens", " ")))
    )


def fire(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, n_rules, confidence) of the token sets on which some rule fires."""
    index = rules.select("rule_id", "confidence", F.size("tokens").alias("need"), F.explode("tokens").alias("token"))
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(runtime.checked_broadcast(index), "token")
    whole = hits.groupBy("tokens", "rule_id", "need", "confidence").agg(F.count(F.lit(1)).alias("have")).filter("have = need")
    return whole.groupBy("tokens").agg(F.count(F.lit(1)).alias("n_rules"), F.max("confidence").alias("confidence"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    labels: DataFrame,
    key: str = "page_id",
    url: str = "url",
    min_share: float = MIN_SHARE,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(key, host, path, rule, verdict, n_rules, confidence) of every row.

    ``labels`` has (key, block): several labels of a key block if one does, null
    labels are left out. A given rule decides before mined ones; where no rule
    fires the URL is allowed. A null URL has no tokens. Rows that repeat a key
    are judged one by one. Other columns are not read; an empty table gives no rows.
    """
    rows = pages.select(F.col(key), F.col(url).cast("string").alias("_url")).select(
        F.col(key), host_of("_url").alias("host"), path_of("_url").alias("path"), F.coalesce(tokens_of("_url"), F.array().cast("array<string>")).alias("tokens")
    )
    known = labels.filter(F.col("block").isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max("block").alias("block"))
    mined = mine(rows.join(known, F.col(key) == F.col("_key")).select("tokens", "block"), min_share, min_count, min_confidence)
    rule, given = longest_rule(rules, F.col("host"), F.col("path"))
    rows = rows.withColumn("rule", rule).withColumn("_given", given)
    if mined is None:
        rows = rows.withColumn("n_rules", F.lit(0).cast("long")).withColumn("confidence", F.lit(None).cast("double"))
    else:
        fired = fire(rows.select("tokens").distinct(), mined)
        rows = rows.join(runtime.checked_broadcast(fired), "tokens", "left").withColumn("n_rules", F.coalesce("n_rules", F.lit(0)))
    verdict = F.coalesce("_given", F.when(F.col("n_rules") > 0, "block").otherwise("allow"))
    return rows.select(key, "host", "path", "rule", verdict.alias("verdict"), "n_rules", "confidence")
