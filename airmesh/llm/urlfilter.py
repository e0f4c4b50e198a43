"""URL filtering by rules for hosts and paths, and by mined association rules.

A list of fixed rules (host suffix, path prefix) judges the urls it fits; the
longest rule wins.  The urls that it judges are the labelled set from which
Spark's FP-growth mines combinations of url tokens that go with ``block``:
rules that pass least support and confidence, and that no shorter rule already
implies, are kept and matched to all other urls by an inverted index: a rule
is filed under its rarest token, a url's tokens are joined with the index, and
a rule holds if the url has all its tokens.  A rule must also be lifted over
all urls, open ones taken as ordinary: labelled urls are no fair draw of them.

Urls are counted once, however many pages have them.  A combination of up to
three tokens is one item of the mining, so that no longer ones are grown; least
support is a share of the labelled urls, so frequent combinations are bounded
by those of a url over that share, whatever the table's size.

Defined results: a null url or one without ``://`` has an empty host and path
and fits no rule; without labelled urls nothing is mined and the method allows;
repeated rows each keep their row; other columns stay out of it.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed values: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: A mined combination is in at least this share of the labelled urls, and in so many of them.
LEAST_SUPPORT = 0.002
LEAST_ROWS = 5
#: Blocked share of the urls that a rule fits over that of all urls, open urls counted as ordinary.
LEAST_LIFT = 1.5
LEAST_CONFIDENCE = 0.8
#: Most tokens in a mined combination.
MOST_TOKENS = 3
_BLOCK = "verdict=block"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column) -> Column:
    """The longest rule that fits as a struct (rule, verdict), or null."""
    out: Column | None = None
    for own, prefix, verdict in sorted(RULES, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(prefix)
        value = F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels and suffixes, path parts, query keys, fragment."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    # from two labels on: a suffix of one label is that label
    suffixes = F.transform(F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))),
                           lambda i: F.concat(F.lit("site="), F.array_join(F.slice(labels, -i, i), ".")))
    parts = F.filter(F.split(path, r"[/.]"), lambda x: (x != "") & ~x.rlike(r"^\d+$"))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key="), F.substring_index(x, "=", 1)))
    return F.array_distinct(F.concat(
        F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1)))),
        F.transform(labels, lambda x: F.concat(F.lit("host="), x)), F.when(F.size(labels) > 1, suffixes).otherwise(F.array().cast("array<string>")),
        F.transform(parts, lambda x: F.concat(F.lit("part="), x)), keys,
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))))


def mine_rules(labelled: DataFrame) -> DataFrame:
    """(tokens, confidence, hits, rarest) of combinations that go with block, from ``labelled`` (tokens, blocked).

    ``hits``: the rows that have the combination and are blocked.  A
    combination is one item: a basket is one combination of a row, with its
    verdict.  So none longer than ``MOST_TOKENS`` is ever grown, whatever urls share.
    """
    spark = labelled.sparkSession
    labelled = stored(labelled.withColumn("row", F.monotonically_increasing_id()), "url-labels")
    total = labelled.count()
    least = max(LEAST_ROWS, math.ceil(LEAST_SUPPORT * total))
    rows = labelled.select("row", "blocked", F.explode("tokens").alias("token"))
    common = rows.groupBy("token").count().filter(F.col("count") >= least).select("token")
    # a fixed number of parts: a row becomes hundreds of baskets, which so few small rows must not all become in one task
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = stored(rows.join(common, "token").repartition(parts, "row").groupBy("row").agg(F.max("blocked").alias("blocked"), F.array_sort(F.collect_set("token")).alias("items")), "url-items")
    m = F.size("items").cast("double")
    n_baskets = kept.agg(F.sum(m + m * (m - 1) / 2 + m * (m - 1) * (m - 2) / 6)).first()[0]
    if not n_baskets:
        return spark.createDataFrame([], "tokens array<string>, confidence double, hits long, rarest string")
    item = F.to_json("tokens")
    baskets = combinations(kept).select(F.when(F.col("blocked"), F.array(item, F.lit(_BLOCK))).otherwise(F.array(item)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_baskets, minConfidence=LEAST_CONFIDENCE, numPartitions=parts).fit(baskets)
    tokens = lambda c: F.from_json(c, "array<string>")
    mined = (model.associationRules.filter(F.col("consequent")[0] == _BLOCK)
             .select(tokens(F.col("antecedent")[0]).alias("tokens"), "confidence", F.round(F.col("support") * n_baskets).cast("long").alias("hits")))
    alone = (model.freqItemsets.filter((F.size("items") == 1) & (F.col("items")[0] != _BLOCK))
             .select(tokens(F.col("items")[0]).alias("one"), "freq").filter(F.size("one") == 1).select(F.col("one")[0].alias("token"), "freq"))
    filed = (mined.withColumn("token", F.explode("tokens")).join(alone, "token")
             .groupBy("tokens", "confidence", "hits").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest")))
    return stored(filed, "url-rules")


def combinations(rows: DataFrame) -> DataFrame:
    """(blocked, tokens): every combination of one to ``MOST_TOKENS`` of each row's sorted ``items``."""
    grown = rows.select("blocked", F.array().cast("array<string>").alias("tokens"), F.col("items").alias("rest"))
    for _ in range(MOST_TOKENS):
        # each step takes one more of those after the last one taken, or ends there: a row at a time, no list of all
        more = F.concat(F.array(F.lit(None).cast("string")), "rest")
        grown = grown.select("blocked", "tokens", "rest", F.posexplode(more).alias("at", "token")).select(
            "blocked", F.when(F.col("at") > 0, F.array_append("tokens", F.col("token"))).otherwise(F.col("tokens")).alias("tokens"),
            F.when(F.col("at") > 0, F.expr("slice(rest, at + 1, size(rest))")).otherwise(F.array().cast("array<string>")).alias("rest"))
    return grown.filter(F.size("tokens") > 0).select("blocked", "tokens")


def pruned(rules: DataFrame) -> DataFrame:
    """Rules of which no part, as a rule of its own, is as sure."""
    def parts(tokens: Column) -> Column:
        one = F.transform(tokens, lambda x: F.array(x))
        two = F.flatten(F.transform(tokens, lambda x: F.transform(F.filter(tokens, lambda y: y > x), lambda y: F.array(x, y))))
        return F.filter(F.concat(one, two), lambda p: F.size(p) < F.size(tokens))

    smaller = rules.select("tokens", F.col("confidence").alias("own"), F.explode(parts(F.col("tokens"))).alias("part"))
    implied = (smaller.join(rules.select(F.col("tokens").alias("part"), "confidence"), "part")
               .filter(F.col("confidence") >= F.col("own")).select("tokens").distinct())
    return rules.join(implied, "tokens", "left_anti")


def lifted(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(url, needs): open ``urls`` and the rules that hold for them, of rules that say more than any url does.

    With open urls taken as ordinary ones, the blocked share of the urls that
    have a rule's tokens is at least ``LEAST_LIFT`` times that of all urls: what
    most open urls have does not block them, however sure the labelled ones are.
    """
    index = rules.select(F.col("tokens").alias("needs"), F.col("rarest").alias("token"), "hits", "confidence")
    listed = urls.filter("label is null").select("url", "has", F.explode("has").alias("token"))
    matches = stored(listed.join(index, "token").filter(F.size(F.array_except("needs", "has")) == 0)
                     .select("url", "needs", "hits", "confidence"), "url-matches")
    share = urls.agg(F.avg(F.coalesce((F.col("label") == "block").cast("double"), F.lit(0.0)))).first()[0] or 0.0
    sure = (matches.groupBy("needs", "hits", "confidence").agg(F.count("*").alias("open"))
            .filter(F.col("hits") / (F.col("hits") / F.col("confidence") + F.col("open")) >= LEAST_LIFT * share))
    return matches.join(sure.select("needs"), "needs").select("url", "needs")


def judge_urls(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url)."""
    url = F.when(F.contains("url", F.lit("://")), F.col("url"))
    judged = pages.select("page_id", url.alias("url"))
    judged = judged.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("fixed", rule_of(F.col("host"), F.col("path")))
    # one row for each url: many pages of a hot host share it
    urls = judged.filter("url is not null").groupBy("url", "host", "path").agg(F.first("fixed").alias("fixed"))
    urls = stored(urls.select("url", F.col("fixed.verdict").alias("label"), tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("has")), "urls")
    mined = pruned(mine_rules(urls.filter("label is not null").select(F.col("has").alias("tokens"), (F.col("label") == "block").alias("blocked"))))
    blocked = lifted(mined, urls).select("url").distinct().withColumn("mined", F.lit("block"))
    verdict = F.coalesce(F.col("fixed.verdict"), F.col("mined"), F.lit("allow"))
    fitted = judged.filter(F.col("fixed").isNotNull() | F.col("url").isNull()).withColumn("mined", F.lit(None).cast("string"))
    rest = judged.filter(F.col("fixed").isNull() & F.col("url").isNotNull()).join(blocked, "url", "left")
    return reduce(DataFrame.unionByName, (fitted, rest)).select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"))

