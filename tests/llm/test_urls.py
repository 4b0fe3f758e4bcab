import random

from pyspark.sql import functions as F

from linea.llm import urls
from linea.llm.queries import URL_RULES


def judged(spark, values, mined=None):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(values)], "page_id int, url string, host string")
    if mined is None:
        mined = urls.mine(spark.createDataFrame([], "tokens array<string>, block boolean"))
    return {r.page_id: r for r in urls.judge(df, "url", URL_RULES, mined).collect()}


def test_listed_rules(spark):
    cases = [("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
             ("http://EXAMPLE.Net/de/1?x=/en/", "example.net", "/de/1", "net/", "block"),
             ("https://a.b.example.com/de/", "a.b.example.com", "/de/", "example.com/de/", "block"),
             ("https://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
             ("http://x.org/fr/2#top", "x.org", "/fr/2", "org/fr/", "allow"), ("http://net", "net", "", None, "allow"),
             ("http://a.net?q", "a.net", "", None, "allow"), ("ftp://a.net/#b", "a.net", "/", "net/", "block"),
             ("no scheme example.net/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
             ("a://b.net/x://c.org/fr/", "b.net", "/x://c.org/fr/", "net/", "block"),
             ("http://É.NET/en/\n", "É.net", "/en/\n", "net/", "block"), ("http://example.net/en", "example.net", "/en", "net/", "block"),
             ("http://" + "a." * 5000 + "net/" + "x" * 5000, "a." * 5000 + "net", "/" + "x" * 5000, "net/", "block")]
    got = judged(spark, [c[0] for c in cases])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), cases[i][0]


def test_mined_rules(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        spam = i % 4 == 0
        host = rng.choice(["win-big", "a", "b"]) if spam else rng.choice(["a", "b", "c"])
        seg = "offer" if spam or rng.random() < 0.3 else "news"
        rows.append((f"http://{host}.example.com/{seg}/{i}.html?ref={i}", spam and (host == "win-big" or rng.random() < 0.02)))
    df = spark.createDataFrame(rows, "url string, block boolean")
    mined = urls.mine(df.select(urls.tokens(F.col("url")).alias("tokens"), "block"), min_support=0.02, min_confidence=0.8)
    assert [tuple(r.tokens) for r in mined.collect()] == [("h:win-big",)]
    got = judged(spark, ["https://win-big.example.org/x", "https://a.example.org/offer/1", "https://win-big.org/fr/1", None], mined)
    assert [got[i].verdict for i in range(4)] == ["block", "allow", "allow", "allow"]


def test_tokens_and_empty(spark):
    df = spark.createDataFrame([("https://WWW.a.org/en/12/x9.html?b=1&c&b=2#top",), (None,), ("junk",)], "url string")
    got = [sorted(r[0]) for r in df.select(urls.tokens(F.col("url"))).collect()]
    assert got[0] == sorted(["s:https", "h:www", "h:a", "h:org", "p:en", "p:0", "p:x0.html", "q:b", "q:c", "f:top"])
    assert got[2] == []
    empty = spark.createDataFrame([], "page_id int, url string")
    assert urls.judge(empty, "url", URL_RULES, urls.mine(spark.createDataFrame([], "tokens array<string>, block boolean"))).count() == 0


def test_mined_rules_and_matches_equal_enumeration(spark):
    from itertools import combinations

    rng = random.Random(2)
    rows = []
    for _ in range(400):
        t = sorted({rng.choice("abcdefg") for _ in range(rng.randint(1, 4))})
        rows.append((t, rng.random() < (0.9 if {"a", "b"} <= set(t) or "g" in t else 0.1)))
    n, blocked = len(rows), sum(b for _, b in rows)
    found = {}
    for size in (1, 2, 3):
        for c in combinations("abcdefg", size):
            hold = [b for t, b in rows if set(c) <= set(t)]
            if sum(hold) >= 0.03 * n and sum(hold) / len(hold) >= 0.6 and sum(hold) / len(hold) > blocked / n:
                found[c] = sum(hold) / len(hold)
    want = {c for c, p in found.items() if not any(set(s) < set(c) and q >= p for s, q in found.items())}
    df = spark.createDataFrame(rows + [([], False), ([], False)], "tokens array<string>, block boolean")
    rules = urls.mine(df, min_support=0.03 * n / (n + 2), min_confidence=0.6)
    assert {tuple(r.tokens) for r in rules.collect()} == want and ("a", "b") in want
    counts = df.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("all"))
    numbered = df.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    got = {(r.row, tuple(r.tokens)) for r in urls.matches(numbered, rules, counts).join(rules, "rule").collect()}
    assert got == {(r.row, c) for r in numbered.collect() for c in want if set(c) <= set(r.tokens)}
