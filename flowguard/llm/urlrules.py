"""URL filter: listed rules, then association rules mined by Spark's FP-growth (DataFrame functions only).

Labelled urls become transactions of url tokens and their class; FP-growth finds the combinations, and rules
that lead to a class are pruned by support, confidence, lift and by simpler rules that are as sure.  Rules are
posted under their rarest token: a url meets only the rules of its own tokens, and one fires if the url has
all of its tokens.  Equal urls are judged once.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import BROADCAST_BYTES, broadcast_if_small, materialize

SUPPORT, LEAST = 0.002, 10  #: share of the labelled urls, and number of them, that a combination is found in
CONFIDENCE, LIFT = 0.6, 1.05  #: of a rule at least
ITEMS = 8  #: tokens of a labelled url that ``mine_rules`` keeps if it is not told to mine all of them
RULE_BYTES = 512  #: of a rule in the index, about
GOOD, BAD = "class:good", "class:bad"
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A to Z lower-cased), path and query; all empty where the url is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.char_length(raw) + 1, F.char_length(rest))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    query = F.regexp_extract(tail, r"^[^?#]*\?([^#]*)", 1)
    return F.translate(raw, _AZ, _AZ.lower()), path, query


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens: words of the host, of the path (numbers are one token) and names of the query."""
    words = lambda c, p: F.regexp_extract_all(c, F.lit(p), F.lit(0))
    return F.array_distinct(F.concat(
        F.transform(words(host, r"[^.\-]+"), lambda w: F.concat(F.lit("host:"), w)),
        F.transform(words(path, r"[^/._\-]+"), lambda w: F.concat(F.lit("path:"), F.when(w.rlike("^[0-9]+$"), "#").otherwise(w))),
        F.transform(F.filter(F.transform(F.split(query, "&"), lambda w: F.substring_index(w, "=", 1)), lambda w: w != ""),
                    lambda w: F.concat(F.lit("query:"), w))))


def _transactions(rows: DataFrame, support: float, least: int, items: int | None) -> tuple[DataFrame, DataFrame, float] | None:
    """Transactions ``items`` of labelled ``row, bad, tokens``, the frequent tokens ``token, n, same``, and the share that is frequent.

    same: the token that stands for this one in the transactions.  Where all tokens are mined, those of exactly the same
    rows are one item, since a combination of two of them says no more than one; otherwise each stands for itself.
    """
    total = rows.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")).first()
    need = max(least, math.ceil(support * total["n"]))
    if total["n"] < need:
        return None
    base = total["bad"] / total["n"]
    long = rows.select("row", "bad", F.explode_outer("tokens").alias("token"))
    # frequent tokens number at most (tokens of a url) / support
    rows_of = [F.bit_xor(F.xxhash64("row")).alias("h1"), F.bit_xor(F.xxhash64(F.lit("same"), "row")).alias("h2")]
    known = long.where("token is not null").groupBy("token").agg(F.count("*").alias("n"), F.avg(F.col("bad").cast("double")).alias("rate"), *rows_of).where(F.col("n") >= need)
    same = F.min("token").over(Window.partitionBy("n", "h1", "h2")) if items is None else F.col("token")
    known = broadcast_if_small(known.select("token", "n", (F.abs(F.col("rate") - base) * F.sqrt("n")).alias("says"), same.alias("same")), 160)
    told = F.when(F.col("says").isNotNull() & (F.col("token") == F.col("same")), F.struct((-F.col("says")).alias("s"), "token"))  # the list leaves nulls out
    kept = long.join(known, "token", "left").groupBy("row", "bad").agg(F.array_sort(F.collect_list(told)).alias("t"))
    mined = F.transform("t", lambda x: x["token"])
    mined = mined if items is None else F.slice(mined, 1, items)
    kept = kept.select(F.concat(mined, F.array(F.when(F.col("bad"), BAD).otherwise(GOOD))).alias("items"))
    return materialize(kept), known, (need - 0.5) / total["n"]  # half a row below, so that rounding cannot ask for one more


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT,
               least: int = LEAST, items: int | None = ITEMS) -> DataFrame:
    """``tokens (sorted), block, confidence, support, lift, post`` of the rules that labelled ``url, bad`` give.

    All labelled rows are mined; rows of null label take no part.  items: None mines all frequent tokens of every url,
    which gives all rules; a number mines only as many of a url, those that say most about the class.  A rule is dropped if a rule of fewer of its tokens for the same
    class is as sure.  post: the rarest token of the rule, which it is posted under.  Fewer than ``least`` rows give no rule.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("bad").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "bad", url_tokens(*url_parts(F.col("url"))).alias("tokens"))
    rows = materialize(rows)
    got = _transactions(rows, support, least, items)
    if got is None:
        return spark.range(0).select(F.array().cast("array<string>").alias("tokens"), F.lit(True).alias("block"), F.lit(0.0).alias("confidence"),
                                     F.lit(0.0).alias("support"), F.lit(0.0).alias("lift"), F.lit("").alias("post"))
    transactions, known, support = got
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(transactions)
    rules = materialize(model.associationRules.where(F.col("consequent")[0].isin(GOOD, BAD)).select(
        F.array_sort("antecedent").alias("tokens"), (F.col("consequent")[0] == BAD).alias("block"), "confidence", "support", "lift"))
    subset = F.transform(F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, size(tokens)) - 2")),
                         lambda m: F.filter("tokens", lambda t, i: m.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) > 0))
    parts = rules.where((F.size("tokens") > 1) & (F.col("lift") >= lift)).select(F.col("tokens").alias("whole"), "block", "confidence", F.explode(subset).alias("tokens"))
    simpler = rules.select("tokens", "block", F.col("confidence").alias("other"))
    worse = parts.join(simpler, ["tokens", "block"]).where(F.col("other") >= F.col("confidence")).select(F.col("whole").alias("tokens"), "block").distinct()
    rules = rules.where(F.col("lift") >= lift).join(worse, ["tokens", "block"], "left_anti")
    if items is None:  # each token for which an item stands has the item's rules
        stands = known.groupBy(F.col("same").alias("item")).agg(F.collect_list("token").alias("members"))
        wide = rules.withColumn("rule", F.monotonically_increasing_id())
        wide = materialize(wide)
        lists = wide.select("rule", F.explode("tokens").alias("item")).join(stands, "item").groupBy("rule").agg(F.collect_list("members").alias("lists"))
        each = F.aggregate("lists", F.array(F.array().cast("array<string>")), lambda done, members: F.flatten(
            F.transform(done, lambda d: F.transform(members, lambda m: F.concat(d, F.array(m))))))
        rules = materialize(wide.drop("tokens").join(lists.select("rule", F.explode(each).alias("tokens")), "rule").select(
            F.array_sort("tokens").alias("tokens"), "block", "confidence", "support", "lift"))
    posts = rules.select("tokens", "block", F.explode("tokens").alias("token")).join(known, "token").groupBy("tokens", "block").agg(
        F.min(F.struct("n", "token")).alias("rare")).select("tokens", "block", F.col("rare.token").alias("post"))
    return materialize(rules.join(posts, ["tokens", "block"]))


def fire(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``key, block, confidence, because`` of the surest rule that fires on each of ``key, tokens``; the others are absent.

    Of equally sure rules that of more support, then more tokens, then one that blocks.
    """
    index = rules.groupBy("post").agg(F.collect_list(F.struct("confidence", "support", F.size("tokens").alias("size"), "block", "tokens")).alias("rules"))
    if rules.count() * RULE_BYTES <= BROADCAST_BYTES:  # an index of rules, not of urls
        index = F.broadcast(index)
    met = urls.select("key", "tokens", F.explode("tokens").alias("post")).join(index, "post")
    fired = met.select("key", F.filter("rules", lambda r: F.size(F.array_except(r["tokens"], F.col("tokens"))) == 0).alias("r")).where(F.size("r") > 0)
    best = fired.select("key", F.array_max("r").alias("r")).groupBy("key").agg(F.max("r").alias("r"))
    return best.select("key", F.col("r.block").alias("block"), F.col("r.confidence").alias("confidence"), F.array_join("r.tokens", " ").alias("because"))


def listed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``key, rule, block`` of the longest rule ``host, path, block`` that fits each of ``key, host, path``.

    A rule fits its host and all subdomains if the url's path starts with the rule's.  Rules are met by host
    suffix and path beginning, both equal, so no url meets a rule that does not fit.  Of rules of equal length that
    of the longer host; of equal rules one that blocks.
    """
    rules = materialize(rules.select("host", "path", "block"))
    dots = rules.agg(F.max(F.regexp_count("host", F.lit(r"\."))).alias("d")).first()["d"]
    if dots is None:
        return urls.select("key", F.lit("").alias("rule"), F.lit(True).alias("block")).limit(0)
    # the last 1, 2, ... labels of a host, as many as a rule has
    suffixes = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(dots + 1)), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k)))
    lengths = broadcast_if_small(rules.select("host", F.char_length("path").alias("n")).distinct(), 64)
    asked = urls.select("key", "path", F.explode(suffixes).alias("host")).join(lengths, "host").where(F.char_length("path") >= F.col("n"))
    asked = asked.select("key", "host", F.expr("left(path, n)").alias("path"))
    fits = asked.join(broadcast_if_small(rules, 256), ["host", "path"])
    best = fits.groupBy("key").agg(F.max(F.struct(
        (F.char_length("host") + F.char_length("path")).alias("n"), F.char_length("host").alias("h"), "block", "host", "path")).alias("r"))
    return best.select("key", F.concat("r.host", "r.path").alias("rule"), F.col("r.block").alias("block"))


def judge(pages: DataFrame, rules: DataFrame, labelled: DataFrame, **mining) -> DataFrame:
    """``page_id, host, path, rule, verdict, because, confidence`` of every row of ``pages(page_id, url)``.

    rules: ``host, path, block``; labelled: ``url, bad``; mining: arguments of ``mine_rules``.  verdict is ``allow`` or ``block``: the longest listed
    rule's, else that of the surest mined rule that fires, else ``allow``.  A null url, or one without ``://``, has an
    empty host and path and no rule.  Repeated rows and null page_ids are judged like others; an empty table gives
    none; other columns are ignored.
    """
    host, path, query = url_parts(F.col("url"))
    pages = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).withColumn("key", F.md5(F.col("url").cast("binary")))
    urls = pages.groupBy("key").agg(F.any_value("url").alias("url"))
    urls = materialize(urls.select("key", host.alias("host"), path.alias("path"), url_tokens(host, path, query).alias("tokens")))
    by_list = materialize(listed(urls, rules))
    by_method = fire(urls.join(by_list.select("key"), "key", "left_anti"), mine_rules(labelled, **mining))
    judged = urls.select("key", "host", "path").join(by_list, "key", "left").join(
        by_method.select("key", F.col("block").alias("mined"), "confidence", "because"), "key", "left")
    judged = judged.select("key", "host", "path", "rule", F.when(F.coalesce("block", "mined", F.lit(False)), "block").otherwise("allow").alias("verdict"),
                           "because", "confidence")
    return pages.select("page_id", "key").join(judged, "key").drop("key")
