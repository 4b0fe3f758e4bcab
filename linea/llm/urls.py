"""URL filters: listed rules, and association rules mined from labelled URLs.

A URL becomes a set of tokens: scheme, labels of its host, segments of its
path (digits as one token), keys of its query, fragment. Spark's FP-growth
mines the token combinations of labelled URLs with the label as one more
token; rules that conclude the label to be blocked are pruned by support and
confidence, and by a shorter rule of at least the same confidence. A kept rule
is indexed under its rarest token: a URL meets only the rules filed under its
own tokens, and a rule fits if the URL has all of its tokens. URLs that no
rule fits are allowed.

Listed rules are (host, path) pairs: a rule fits its host and all subdomains
if the path starts with the rule's; the longest wins, and comes before mined
rules.

Edge cases: a URL that is null or holds no ``://`` has an empty host and path
and the token set of its parts (none); it is allowed. Repeated rows are judged
one by one. No labelled URL, or only one label: nothing is mined. Empty tables
give empty results. Other columns pass through.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.llm.common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKED = "=block"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host_col: Column, path_col: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest listed rule (verdict, host, path) that fits, or null."""
    dotted = F.concat(F.lit("."), host_col)
    fits = [F.when(dotted.endswith("." + h) & path_col.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def tokens(url: Column) -> Column:
    """Different tokens of a URL, each marked with the part it comes from."""
    mark = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    scheme = F.coalesce(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit(""))
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    fragment = F.coalesce(F.regexp_extract(url, r"(?s)#(.*)$", 1), F.lit(""))
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    segments = F.transform(F.split(path(url), "/"), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    return F.array_distinct(F.concat(mark("s:", F.array(scheme)), mark("h:", F.split(host(url), r"\.")), mark("p:", segments),
                                     mark("q:", keys), mark("f:", F.array(fragment))))


def mine(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.5, max_tokens: int = 3) -> DataFrame:
    """Rules (rule bigint, tokens, confidence, support) from rows of (tokens, block boolean).

    Support is the share of labelled rows that hold a rule's tokens and are
    blocked. Tokens that too few blocked rows hold are left out beforehand: no
    rule with enough support can use them.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "rule bigint, tokens array<string>, confidence double, support double")
    rows = materialise(labelled.select("tokens", F.coalesce(F.col("block"), F.lit(False)).alias("block")))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("block").cast("int")).alias("b")).first()
    if not sizes["n"] or not sizes["b"] or sizes["b"] == sizes["n"]:
        return empty
    # mine the blocked rows alone: their frequent combinations are those with enough support
    blocked = rows.where("block")
    share = min(1.0, max(min_support * sizes["n"] / sizes["b"], 2.0 / sizes["b"]))
    single = (rows.select(F.explode("tokens").alias("t"), "block").groupBy("t")
              .agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("block").cast("int")).alias("held")))
    # a token that (almost) every row holds tells nothing, and one that few blocked rows hold is in no rule
    useful = single.where((F.col("held") >= share * sizes["b"]) & (F.col("all") < 0.95 * sizes["n"])).select("t")
    slim = (blocked.withColumn("r", F.monotonically_increasing_id()).select("r", F.explode("tokens").alias("t"))
            .join(useful, "t").groupBy("r").agg(F.collect_set("t").alias("items")))
    slim = materialise(slim)
    if slim.isEmpty():
        return empty
    sets = FPGrowth(itemsCol="items", minSupport=share * sizes["b"] / max(1, slim.count()) if share < 1 else 1.0,
                    minConfidence=1.0).fit(slim).freqItemsets
    sets = materialise(sets.where(F.size("items") <= max_tokens).select(F.sort_array("items").alias("tokens"), F.col("freq").alias("b"))
                       .withColumn("rule", F.xxhash64("tokens")))
    every = matches(rows.withColumn("row", F.monotonically_increasing_id()), sets, single.select("t", "all"))
    held = every.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    rules = sets.join(held, "rule").select("rule", "tokens", (F.col("b") / F.col("n")).alias("confidence"),
                                           (F.col("b") / F.lit(float(sizes["n"]))).alias("support"))
    rules = materialise(rules.where((F.col("confidence") >= min_confidence) & (F.col("confidence") > sizes["b"] / sizes["n"])))
    # drop a rule that a part of it equals in confidence
    parts = rules.select(F.col("rule"), "confidence", F.explode("tokens").alias("t"), "tokens")
    shorter = rules.select(F.col("tokens").alias("s"), F.col("confidence").alias("c"), F.element_at("tokens", 1).alias("t"))
    beaten = parts.join(shorter, "t").where((F.size("s") < F.size("tokens")) & (F.size(F.array_except("s", "tokens")) == 0)
                                            & (F.col("c") >= F.col("confidence"))).select("rule").distinct()
    return materialise(rules.join(beaten, "rule", "left_anti"))


def matches(rows: DataFrame, rules: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, rule) for every rule (rule, tokens) that fits a row (row, tokens), by the rules' rarest tokens.

    ``counts`` (t, all): how often each token occurs.
    """
    filed = rules.select("rule", F.col("tokens").alias("needs"), F.explode("tokens").alias("t")).join(counts, "t", "left")
    filed = (filed.groupBy("rule", "needs").agg(F.min(F.struct(F.coalesce("all", F.lit(0)), "t"))["t"].alias("t")))
    met = rows.select("row", "tokens", F.explode("tokens").alias("t")).join(filed, "t")
    return met.where(F.size(F.array_except("needs", "tokens")) == 0).select("row", "rule")


def judge(pages: DataFrame, url: str, rules: list[tuple[str, str, str]], mined: DataFrame) -> DataFrame:
    """``pages`` with host, path, rule and verdict (these replace columns of the same names)."""
    rows = pages.withColumn("__host", host(F.col(url))).withColumn("__path", path(F.col(url)))
    rows = rows.withColumn("__listed", listed(F.col("__host"), F.col("__path"), rules))
    urls = rows.where(F.col("__listed").isNull() & F.col(url).isNotNull()).select(F.col(url).alias("row")).distinct()
    urls = urls.withColumn("tokens", tokens(F.col("row")))
    counts = urls.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("all"))
    if mined.isEmpty():
        method = F.lit("allow")
    else:
        hit = matches(urls, mined, counts).select(F.col("row").alias("__hit")).distinct()
        rows = rows.join(hit, F.col(url) == F.col("__hit"), "left")
        method = F.when(F.col("__hit").isNotNull(), "block").otherwise("allow")
    out = rows.withColumns({"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__listed.rule"),
                            "verdict": F.coalesce(F.col("__listed.verdict"), method)})
    return out.drop("__host", "__path", "__listed", "__hit")
