"""URL filters (operator 11): listed rules, and association rules mined from labelled URLs.

A list of rules (host, path, verdict) decides the URLs that it covers: a rule fits
its host and all subdomains where the URL's path starts with the rule's, and the
longest rule wins.  Every URL offers the keys that a rule could have (each suffix
of its host with each beginning of its path that is as long as some rule's path),
so rules are found by an equi-join, however many there are.

The other URLs are judged by association rules.  Labelled URLs (those that the list
decides, or a table of labels) are sets of tokens: labels of the host, words of
the path with numbers as one token, names of query parameters.  FP-growth finds the
token combinations that a share of ``SUPPORT`` of the labelled URLs has; a
combination whose URLs have one verdict with a confidence of ``CONFIDENCE`` or
more, and more often than all labelled URLs, is a rule, unless a part of the
combination already predicts that verdict as surely.  Rules lie in an inverted
index under their rarest token; URLs look up their tokens, and of the rules that
fit whole the one with the highest confidence decides (then more URLs, fewer
tokens, the first by its tokens).  A URL without a rule gets ``DEFAULT``.  URLs with
the same indexed tokens are looked up once.

All steps are joins and aggregates over distinct keys.  To the driver come the
lengths of the rules' paths and the tokens of the mined rules, at most the mean
number of tokens of a URL over ``SUPPORT``, whatever the size of the table.

Defined results: a null URL and one without ``://`` have an empty host and path and
no token, so they get ``DEFAULT``; an empty path is fitted by no rule that has one;
very long URLs are read whole; repeated rows are judged and counted each; rules
given twice count once, as a block if any says so; without labelled URLs no rule is
mined; extra columns pass through, but those with the names of results are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, stored

#: The list that the query applies, as (host, path, verdict).
LIST = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Share of the labelled URLs, and their number, that a combination needs; confidence of a rule; verdict without any rule.
SUPPORT, FEWEST, CONFIDENCE, DEFAULT = 0.01, 5, 0.7, "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OUT = ("host", "path", "rule", "verdict", "mined_rule", "confidence")
_REST = 2**31 - 1


def _after(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit(_REST))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens in order: h:label of the host, p:word of the path (numbers are p:#), q:name of a parameter."""
    after = _after(url)
    query = F.regexp_extract(after, r"^[^?#]*\?([^#]*)", 1)
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    words = F.split(F.translate(path_of(url), UPPER, LOWER), r"[^a-z0-9\x{80}-\x{10ffff}]+")
    words = F.transform(words, lambda x: F.when(F.rlike(x, F.lit("^[0-9]+$")), "#").otherwise(x))
    parameters = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_sort(F.array_distinct(F.concat(named("h:", F.split(host_of(url), r"\.")), named("p:", words), named("q:", parameters))))


def listed(urls: DataFrame, rules: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, head, rule, verdict) of the distinct (host, head) of ``urls`` that a rule fits; the longest wins."""
    one = rules.groupBy("host", "path").agg(F.min(F.struct((F.col("verdict") != "block").alias("k"), "verdict"))["verdict"].alias("verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    begun = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("head")), lambda n: F.substring(F.col("head"), F.lit(1), n))
    keys = urls.select("host", "head").distinct().select("host", "head", F.explode(suffixes).alias("rule_host"), begun.alias("begun"))
    keys = keys.select("host", "head", "rule_host", F.explode("begun").alias("rule_path"))
    found = keys.join(one.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"), ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), "verdict"), F.struct(F.length(rule), F.length("rule_host")))
    return found.groupBy("host", "head").agg(best.alias("b")).select("host", "head", "b.rule", "b.verdict")


def mined(labelled: DataFrame, support: float = SUPPORT, fewest: int = FEWEST, confidence: float = CONFIDENCE) -> DataFrame:
    """(token, tokens, verdict, hits, n, confidence): rules from rows (tokens, verdict), each under its rarest token.

    ``n``: labelled URLs with the tokens; ``hits``: those of them with the verdict.
    """
    empty = labelled.sparkSession.createDataFrame([], "token string, tokens array<string>, verdict string, hits long, n long, confidence double")
    total = labelled.count()
    if not total:
        return empty
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit("="), "verdict")).alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, fewest / total)), minConfidence=1.0).fit(baskets).freqItemsets
    label = F.get(F.filter("items", lambda x: F.startswith(x, F.lit("="))), F.lit(0))
    sets = stored(sets.select(F.array_sort(F.filter("items", lambda x: ~F.startswith(x, F.lit("=")))).alias("tokens"), F.substring(label, F.lit(2), F.lit(_REST)).alias("verdict"), F.col("freq").alias("n")), "itemsets")
    shares = {r["verdict"]: r["n"] / total for r in sets.where(F.col("verdict").isNotNull() & (F.size("tokens") == 0)).collect()}
    if not shares:
        return empty
    share = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("verdict"))
    plain = sets.where(F.col("verdict").isNull()).select("tokens", "n")
    rules = sets.where(F.col("verdict").isNotNull() & (F.size("tokens") > 0)).withColumnRenamed("n", "hits").join(plain, "tokens")
    rules = rules.withColumn("confidence", F.col("hits") / F.col("n")).where((F.col("confidence") >= confidence) & (F.col("confidence") > share))
    # a rule goes if one of its parts is as sure; parts of parts follow
    parts = rules.where(F.size("tokens") > 1).select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    parts = parts.select("tokens", "verdict", "confidence", F.array_remove("tokens", F.col("token")).alias("part"))
    surer = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("of_part"))
    needless = parts.join(surer, ["part", "verdict"]).where(F.col("of_part") >= F.col("confidence")).select("tokens", "verdict").distinct()
    rules = rules.join(needless, ["tokens", "verdict"], "left_anti")
    often = plain.where(F.size("tokens") == 1).select(F.get("tokens", F.lit(0)).alias("token"), F.col("n").alias("often"))
    posted = rules.withColumn("token", F.explode("tokens")).join(often, "token")
    return posted.groupBy("tokens", "verdict").agg(F.min(F.struct("often", "token"))["token"].alias("token"), *[F.first(c).alias(c) for c in ("hits", "n", "confidence")]).select(*empty.columns)


def matched(signatures: DataFrame, index: DataFrame) -> DataFrame:
    """(signature, verdict, mined_rule, confidence) of the distinct signatures that a rule of the inverted index fits."""
    posted = signatures.select("signature").distinct().select("signature", F.explode("signature").alias("token"))
    found = posted.join(index, "token").where(F.forall("tokens", lambda t: F.array_contains(F.col("signature"), t)))
    order = F.struct((-F.col("confidence")).alias("a"), (-F.col("hits")).alias("b"), F.size("tokens").alias("c"), "tokens", "verdict")
    best = found.groupBy("signature").agg(F.min_by(F.struct("verdict", F.array_join("tokens", "+").alias("mined_rule"), "confidence"), order).alias("b"))
    return best.select("signature", "b.*")


def judged(pages: DataFrame, rules: DataFrame, labels: DataFrame | None = None, url: str = "url", support: float = SUPPORT, fewest: int = FEWEST, confidence: float = CONFIDENCE, default: str = DEFAULT) -> DataFrame:
    """All columns of ``pages`` with host, path, rule (of the list), verdict, mined_rule and its confidence.

    ``rules``: (host, path, verdict).  ``labels``: (url, verdict) to mine from; without it, the URLs that the list decides.
    """
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    (row,) = fresh(pages, "row")
    pages = pages.select(*[c for c in pages.columns if c == url or c not in _OUT])
    address = F.col(row)[url]
    a = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias(row))
    a = a.select(row, host_of(address).alias("host"), path_of(address).alias("path"), tokens_of(address).alias("tokens"))
    a = a.withColumn("head", F.substring("path", 1, max(lengths, default=0)))
    known = stored(listed(a, rules, lengths), "listed")
    a = a.join(known.withColumnRenamed("verdict", "by_list"), ["host", "head"], "left")
    if labels is None:
        labelled = a.where(F.col("by_list").isNotNull()).select("tokens", F.col("by_list").alias("verdict"))
    else:
        labelled = labels.select(tokens_of(F.col("url")).alias("tokens"), "verdict").where(F.col("verdict").isNotNull())
    index = stored(mined(labelled, support, fewest, confidence), "index")
    words = sorted(r[0] for r in index.select(F.explode("tokens")).distinct().collect())
    a = a.withColumn("signature", F.array_intersect("tokens", F.array(*[F.lit(w) for w in words]).cast("array<string>")))
    hits = stored(matched(a.where(F.col("by_list").isNull()), index), "matched")
    a = a.join(hits, "signature", "left")
    kept = [F.col(row)[c].alias(c) for c in pages.columns if c not in _OUT]
    own = F.col("by_list").isNull()
    return a.select(*kept, "host", "path", "rule", F.coalesce("by_list", "verdict", F.lit(default)).alias("verdict"), F.when(own, F.col("mined_rule")).alias("mined_rule"), F.when(own, F.col("confidence")).alias("confidence"))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(pages, spark.createDataFrame(LIST, "host string, path string, verdict string")).drop("url")
