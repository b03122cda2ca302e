"""URL filtering by association rules over URL tokens.

Explicit rules (host and path prefix, longest wins) give some urls a verdict.  These
verdicts are the labels: every labelled url is a basket of its tokens (host labels, host
suffixes, path segments, file endings, query names) plus its verdict, and Spark's
FP-growth mines the frequent baskets.  Association rules "tokens => block" that reach
the least confidence are kept, and of nested token sets with no more confidence only the
smallest.

Tokens that occur in the very same labelled urls (all segments of one url that a crawler
repeats, say) are one item, else their 2^n subsets would all be frequent.  Such tokens are
found by hash aggregates of the rows that hold them; tokens of the host and tokens after
it stay apart, as rules need one of the latter.  Any token of an item stands for it.

The other urls are matched through an inverted index: every rule is filed under its
rarest item, urls look their items up there, and a rule fires when the url holds all of
its items.

Only pruned rules go into the index, whose written size decides between a broadcast and a
shuffle.  Counting is over all labelled urls; nothing is sampled.

Defined results
    null url or no ``://``: host and path empty, no rule, no tokens, allowed
    no labelled urls or none blocked: no rules are mined, the other urls are allowed
    ties between explicit rules of equal length: cannot fit one url with different verdicts
    repeated rows: each is judged by itself; they count as often as they occur
    very long urls: all of their tokens count; a url has one item per set of equal tokens
    extra input columns: not read
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan.session import stage

# The explicit rules.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
BLOCKED = "verdict=block"
AFTER_HOST = "^(path|ending|query):"

REST = "CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END"


def split_url(rest: str) -> tuple[str, str]:
    """SQL of the host (ASCII letters in lower case) and the path of what follows ``://``."""
    host = f"regexp_extract({rest}, '^([^/?#]*)', 1)"
    path = f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    return f"translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')", path


def explicit_rule() -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct of rule and verdict."""
    fits = []
    for rule, verdict in RULES:
        host, _, path = rule.partition("/")
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        here = own & F.startswith(F.col("path"), F.lit("/" + path))
        fits.append(
            F.when(here, F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
        )
    return F.array_max(F.array_compact(F.array(*fits)))


def tokens() -> str:
    """SQL of the distinct tokens of ``host``, ``path`` and ``rest``.

    Tokens of the host: its first label and all of its suffixes.  Tokens after the host:
    path segments that are not numbers, the ending of a file, names of query fields.
    """
    labels = "split(host, '[.]')"
    return (
        "CASE WHEN host = '' THEN CAST(array() AS array<string>) ELSE array_sort(array_distinct(concat("
        f"array(concat('label:', {labels}[0])),"
        f" transform(sequence(1, size({labels})), i -> concat('site:', array_join(slice({labels}, -i, i), '.'))),"
        " transform(filter(split(path, '/'), x -> x <> '' AND NOT x RLIKE '^[0-9]+([.][A-Za-z0-9]+)?$'),"
        " x -> concat('path:', lower(x))),"
        " transform(filter(array(regexp_extract(path, '[.]([A-Za-z0-9]{1,5})$', 1)), x -> x <> ''),"
        " x -> concat('ending:', lower(x))),"
        " transform(regexp_extract_all(regexp_extract(rest, '[?]([^#]*)', 1), '([^=&]+)(?:=[^&]*)?', 1),"
        " x -> concat('query:', lower(x)))))) END"
    )


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (null without a rule), tokens."""
    urls = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url")
    )
    host, path = split_url("rest")
    split = urls.withColumn("rest", F.expr(REST)).withColumns({"host": F.expr(host), "path": F.expr(path)})
    split = split.withColumn("fit", explicit_rule())
    return split.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.col("fit.verdict").alias("verdict"),
        F.expr(tokens()).alias("tokens"),
    )


def merged(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """token, item of every frequent token: tokens of the very same rows share the least of them as item.

    ``labelled`` has distinct ``row`` and ``tokens``.  Rows of a token are compared by their
    number and two exclusive-or sums of 64-bit hashes.  There are at most (mean number of
    tokens of a row) / ``min_support`` frequent tokens.
    """
    held = labelled.filter(F.size("tokens") > 0)
    least = math.ceil(min_support * held.count())
    same = (
        held.select("row", F.explode(F.array_distinct("tokens")).alias("token"))
        .groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("row")).alias("h1"),
            F.bit_xor(F.xxhash64(F.lit("second"), "row")).alias("h2"),
        )
        .filter(F.col("n") >= least)
        .withColumn("after_host", F.col("token").rlike(AFTER_HOST))
    )
    items = same.groupBy("n", "h1", "h2", "after_host").agg(F.collect_list("token").alias("tokens"))
    return items.select(F.explode("tokens").alias("token"), F.array_min("tokens").alias("item"))


def with_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` with ``tokens`` replaced by the sorted, distinct ``items`` they stand for."""
    held = rows.select("row", F.explode(F.array_distinct("tokens")).alias("token")).join(items, "token")
    found = held.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return (
        rows.join(found, "row", "left")
        .drop("tokens")
        .withColumn("items", F.coalesce("items", F.expr("CAST(array() AS array<string>)")))
    )


def mine_items(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Pruned rules of ``items``, ``verdict`` rows: antecedent (sorted), confidence, support.

    A rule needs a token after the host: a verdict on hosts alone is for explicit rules.
    """
    items = F.when(F.col("verdict") == "block", F.array_append("items", F.lit(BLOCKED))).otherwise(F.col("items"))
    baskets = stage(labelled.select(items.alias("items")), "baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = stage(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "frequent-sets")
    blocked = sets.filter(F.array_contains("items", BLOCKED)).select(
        F.array_remove("items", BLOCKED).alias("antecedent"), F.col("freq").alias("n_blocked")
    )
    plain = sets.select(F.col("items").alias("antecedent"), "freq")
    counted = blocked.join(plain, "antecedent").withColumn("confidence", F.col("n_blocked") / F.col("freq"))
    is_rule = (F.col("confidence") >= min_confidence) & F.exists("antecedent", lambda t: t.rlike(AFTER_HOST))
    counted = stage(counted.withColumn("is_rule", is_rule), "antecedents")
    # Of nested antecedents the larger one goes unless it is more confident.  Every subset of
    # a frequent set is frequent, so the best confidence inside a set comes from its subsets
    # one item shorter, whether these are rules or not.
    longest = counted.agg(F.max(F.size("antecedent"))).first()[0] or 0
    empty = counted.limit(0).withColumn("inside", F.lit(None).cast("double"))
    levels = [empty]
    for n in range(1, longest + 1):
        own = counted.filter(F.size("antecedent") == n)
        known = levels[-1].select(
            F.col("antecedent").alias("subset"),
            F.greatest("inside", F.when(F.col("is_rule"), F.col("confidence"))).alias("enough"),
        )
        shorter = own.select("antecedent", F.explode(F.expr("transform(antecedent, x -> array_remove(antecedent, x))")).alias("subset"))
        inside = shorter.join(known, "subset").groupBy("antecedent").agg(F.max("enough").alias("inside"))
        levels.append(stage(own.join(inside, "antecedent", "left"), f"antecedents-{n}"))
    kept = reduce(DataFrame.unionByName, levels).filter(
        F.col("is_rule") & (F.col("inside").isNull() | (F.col("inside") < F.col("confidence")))
    )
    n_baskets = baskets.count()
    return kept.select("antecedent", "confidence", (F.col("n_blocked") / F.lit(float(max(1, n_baskets)))).alias("support"))


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Pruned rules of ``tokens``, ``verdict`` rows, spelled out in tokens: antecedent (sorted), confidence, support.

    A report: one row for every choice of a token per item.  ``filtered`` matches items instead.
    """
    held = labelled.filter(F.size("tokens") > 0).select("tokens", "verdict")
    rows = stage(held.withColumn("row", F.monotonically_increasing_id()), "labelled-urls")
    items = stage(merged(rows, min_support), "url-items")
    rules = mine_items(with_items(rows, items), min_support, min_confidence)
    members = items.groupBy("item").agg(F.collect_list("token").alias("members"))
    numbered = stage(rules.withColumn("rule_id", F.monotonically_increasing_id()), "item-rules")
    choices = (
        numbered.select("rule_id", F.explode("antecedent").alias("item"))
        .join(members, "item")
        .groupBy("rule_id")
        .agg(F.collect_list("members").alias("choices"))
    )
    product = (
        "aggregate(choices, array(CAST(array() AS array<string>)),"
        " (made, tokens) -> flatten(transform(made, a -> transform(tokens, t -> array_append(a, t)))))"
    )
    spelled = numbered.drop("antecedent").join(choices, "rule_id").withColumn("antecedent", F.explode(F.expr(product)))
    return spelled.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")


def filtered(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, confidence.

    ``confidence`` is that of the best mined rule that fired, null if none did.
    """
    rows = stage(parsed(pages, id_col, url_col).withColumn("row", F.monotonically_increasing_id()), "parsed-urls")
    ruled = rows.filter("rule IS NOT NULL AND size(tokens) > 0").select("row", "tokens", "verdict")
    items = stage(merged(ruled, min_support), "url-items")
    rules = mine_items(with_items(ruled, items), min_support, min_confidence)
    rules = stage(rules.withColumn("rule_id", F.monotonically_increasing_id()), "pruned-rules")

    # The index: every rule under its rarest item among the urls to be judged.
    others = stage(with_items(rows.filter("rule IS NULL").select("row", "tokens"), items), "url-baskets")
    looked_up = others.select("row", "items", F.explode("items").alias("item"))
    filed = rules.select("rule_id", "antecedent", "confidence", F.explode("antecedent").alias("item"))
    counts = looked_up.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    index = (
        filed.join(counts, "item")
        .groupBy("rule_id", "antecedent", "confidence")
        .agg(F.min(F.struct("n", "item")).alias("rarest"))
        .select("antecedent", "confidence", F.col("rarest.item").alias("item"))
    )
    index = stage(index, "rule-index")
    fired = looked_up.join(index, "item").filter(F.size(F.array_except("antecedent", "items")) == 0)
    best = fired.groupBy("row").agg(F.max("confidence").alias("confidence"))
    return rows.join(best, "row", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "confidence",
    )
