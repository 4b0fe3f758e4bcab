"""Secret scans: fixed patterns, and a randomness test battery for everything else.

Base spans come from three patterns (assign, access, hex). Beside them, every
long run of encoding characters that holds a letter and a digit is a
candidate. Its encoding is the smallest alphabet that holds all its symbols
(hex, base32, base36, base64). The battery tests the run against uniformly
random symbols of that alphabet: chi-squared of the symbol counts, a runs test
around the alphabet's middle, and lag-1 serial correlation, joined by
Bonferroni. Keys pass it, words and paths fail.

Passing is no evidence by itself for a short run, so false discoveries are
controlled against the language of the corpus. With q the frequencies of
symbols in the corpus's own long digit-free words (each symbol has a floor of
1/1000), the likelihood ratio of uniform to q bounds the p-value of the run
under q by 1/ratio (Markov), which gets sharper with length by itself.
Benjamini-Hochberg at rate ``alpha`` runs within each class of length, on p-values
binned by their logarithm, so that the driver sees a few numbers a class.
A run that overlaps a base span is left to that.

Main path: DataFrame functions only. Positions are code points: a pattern's
matches and the pieces between them (``split``) alternate, so their lengths
sum to positions. Edge cases: null or empty text has no spans. Very long texts
are scanned whole. Ties in start are ordered by kind as listed. Repeated rows
are scanned one by one; empty tables give empty results; other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linea.llm.common import let

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Shortest candidate of the battery, and of the words that tell the language's symbols.
SHORTEST, WORD_RUN = 20, 12
RUN = rf"[A-Za-z0-9+/_-]{{{WORD_RUN},}}"
ALPHABETS = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"}
FLOOR = 1e-3
#: Width of a bin of -ln(p), and the lower ends of the classes of length.
BIN, LENGTHS = 0.25, (20, 24, 32, 48, 64, 128)


def _running(values: Column, start: Column) -> Column:
    """Exclusive prefix sums of a short array."""
    zero = F.struct(start.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
    return F.aggregate(values, zero, step)["out"]


def prefix_sums(values: Column, chunk: int = 256) -> Column:
    """Exclusive prefix sums of a bigint array, in two levels so that long arrays stay cheap."""
    def cut(v):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(chunk)), lambda at: F.slice(v, at, F.lit(chunk)))

    def join(chunks):
        sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x))
        return let(_running(sums, F.lit(0)), lambda starts: F.flatten(F.zip_with(chunks, starts, _running)))

    return let(values, lambda v: let(cut(v), join))


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Spans (s, e, kind, v) of a pattern's matches. ``keep``: (group, least length) a match must reach."""
    lit = F.lit(pattern)
    lengths = lambda a: F.transform(a, lambda x: F.length(x).cast("bigint"))
    found = F.regexp_extract_all(text, lit, F.lit(0))

    def located(m):
        # a match starts after all earlier pieces and matches and its own piece
        between = F.slice(lengths(F.split(text, pattern, -1)), F.lit(1), F.size(m))
        both = F.zip_with(between, lengths(m), lambda p, n: p + n)
        start = F.zip_with(prefix_sums(both), between, lambda a, p: a + p)
        return F.zip_with(start, m, lambda s, x: F.struct(s.alias("s"), (s + F.length(x)).alias("e"),
                                                          F.lit(KINDS.index(kind)).alias("kind"), x.alias("v")))

    spans = let(found, located)
    if keep:
        group, least = keep
        good = F.transform(F.regexp_extract_all(text, lit, F.lit(group)), lambda x: F.length(x) >= least)
        marked = F.zip_with(spans, good, lambda x, k: F.struct(x.alias("x"), k.alias("k")))
        spans = F.transform(F.filter(marked, lambda z: z["k"]), lambda z: z["x"])
    return spans


_EMPTY = "array<struct<s:bigint,e:bigint,kind:int,v:string>>"


def scan(text: Column) -> Column:
    """Base spans of a text in order of start and kind: array of (s, e, kind, v)."""
    none = F.array().cast(_EMPTY)
    parts = [F.when(text.rlike(ASSIGN), _spans(text, ASSIGN, "assign", (2, 8))).otherwise(none),
             F.when(text.contains("AKIA"), _spans(text, ACCESS, "access")).otherwise(none),
             F.when(text.rlike(HEX), _spans(text, HEX, "hex")).otherwise(none)]
    return F.array_sort(F.concat(*parts))


def candidates(text: Column, base: Column) -> Column:
    """Runs with a letter and a digit that overlap no base span."""
    some = text.rlike(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}")
    good = lambda x: ((F.length(x["v"]) >= SHORTEST) & x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")
                      & ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return F.when(some, F.filter(_spans(text, RUN, "random"), good)).otherwise(F.array().cast(_EMPTY))


def _upper_tail(z: Column) -> Column:
    """P(Z >= z) of the standard normal, by the logistic approximation (error below 2e-4)."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(0.07056 * z * z * z + 1.5976 * z))


def _battery(v: Column, alphabet: Column, size: Column) -> Column:
    """Bonferroni-joined p-value of a run under uniformly random symbols."""
    def tests(x):
        n = F.size(x).cast("double")
        counts = F.transform(F.array_distinct(x), lambda s: F.size(F.filter(x, lambda y: y == s)).cast("double"))
        chi = size / n * F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) - n
        p_chi = _upper_tail((chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n))
        high = F.size(F.filter(x, lambda y: y * 2 >= size)).cast("double")
        low = n - high
        pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1),
                           lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        runs = 1 + F.size(F.filter(pairs, lambda p: (p["a"] * 2 >= size) != (p["b"] * 2 >= size)))
        mean = 2 * high * low / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = F.when(spread > 0, 2 * _upper_tail(F.abs(runs - mean) / F.sqrt(spread))).otherwise(0.0)
        centre = F.aggregate(x, F.lit(0.0), lambda a, y: a + y) / n
        square = F.aggregate(x, F.lit(0.0), lambda a, y: a + (y - centre) * (y - centre))
        cross = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - centre) * (p["b"] - centre))
        p_serial = F.when(square > 0, 2 * _upper_tail(F.abs(cross / square + 1 / n) * F.sqrt(n))).otherwise(0.0)
        return F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial))

    symbols = F.transform(F.split(v, ""), lambda c: (F.position(c, alphabet) - 1).cast("double"))
    return let(F.filter(symbols, lambda y: y >= 0), tests)


def _class(v: Column) -> Column:
    """Class of length of a run."""
    out = F.lit(0)
    for i, at in enumerate(LENGTHS):
        out = F.when(F.length(v) >= at, F.lit(i)).otherwise(out)
    return out


def _encoding(v: Column) -> Column:
    """Alphabet of the smallest encoding that holds all symbols of a run."""
    return F.coalesce(*[F.when(v.rlike(f"^[{a}]+$"), F.lit(a)) for a in ALPHABETS.values()])


def _evidence(v: Column, q: Column) -> Column:
    """Bin of -ln(p): log likelihood ratio of uniform symbols to the language's, at least 0."""
    size = F.length(_encoding(v)).cast("double")
    ratio = let(size, lambda n: F.aggregate(F.filter(F.split(v, ""), lambda c: F.length(c) > 0), F.lit(0.0),
                                            lambda a, c: a - F.log(n * q[c])))
    return F.floor(F.greatest(ratio, F.lit(0.0)) / BIN).cast("int")


class Judge:
    """Decides whether a run is a secret: language frequencies, and a bin limit for each class of length."""

    def __init__(self, q: dict[str, float], limits: dict[int, int], random_p: float):
        self.q, self.limits, self.random_p = q, limits, random_p

    def table(self) -> Column:
        return F.create_map(*[F.lit(x) for kv in self.q.items() for x in kv])

    def accepts(self, v: Column) -> Column:
        if not self.limits:
            return F.lit(False)
        limit = F.create_map(*[F.lit(x) for kv in self.limits.items() for x in kv])
        alphabet = _encoding(v)
        return (F.coalesce(_evidence(v, self.table()) >= limit[_class(v)], F.lit(False))
                & (_battery(v, alphabet, F.length(alphabet).cast("double")) >= self.random_p))


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` (base spans) and ``__runs`` (candidates)."""
    body = F.coalesce(F.col(text), F.lit(""))
    both = let(scan(body), lambda b: F.struct(b.alias("base"), candidates(body, b).alias("runs")))
    return (docs.withColumn("__found", both).withColumn("__base", F.col("__found.base"))
            .withColumn("__runs", F.col("__found.runs")).drop("__found"))


def language(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Share of each symbol in the corpus's long digit-free words, FLOOR at least (one row to the driver)."""
    words = F.regexp_extract_all(F.col(text), F.lit(rf"[A-Za-z]{{{WORD_RUN},}}"), F.lit(0))
    joined = docs.select(F.array_join(words, "").alias("w")).where("w != ''")
    letters = [c for c in ALPHABETS["base64"] if c.isalpha()]
    counts = joined.agg(*[F.sum(F.length("w") - F.length(F.replace(F.col("w"), F.lit(c), F.lit("")))).alias(f"c{i}")
                          for i, c in enumerate(letters)]).first()
    total = sum(n or 0 for n in counts) or 1
    q = dict.fromkeys(ALPHABETS["base64"], FLOOR)
    return q | {c: max(FLOOR, (n or 0) / total) for c, n in zip(letters, counts, strict=True)}


def learn(runs: DataFrame, q: dict[str, float], alpha: float = 0.01, random_p: float = 0.01) -> Judge:
    """False-discovery limits from all different runs (column ``v``) of the corpus."""
    table = Judge(q, {}, random_p).table()
    counts = (runs.select("v").distinct().select(_class(F.col("v")).alias("stratum"), _evidence(F.col("v"), table).alias("bin"))
              .groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")))
    # a bin's p-value is that of its lower end: exp(-bin * BIN); it passes if p <= alpha * (runs as good) / runs
    better = F.sum("n").over(Window.partitionBy("stratum").orderBy(F.col("bin").desc()))
    every = F.sum("n").over(Window.partitionBy("stratum"))
    passing = F.exp(-F.col("bin") * F.lit(BIN)) <= alpha * F.col("better") / F.col("every")
    limits = (counts.withColumn("better", better).withColumn("every", every).where(passing)
              .groupBy("stratum").agg(F.min("bin").alias("least")).collect())  # a row for each class of length
    return Judge(q, {r["stratum"]: r["least"] for r in limits}, random_p)


def accepted(found: DataFrame, judge: Judge) -> DataFrame:
    """``found`` (of ``scanned``) with ``spans``: base spans and accepted runs in order of start and kind."""
    extra = F.filter(F.col("__runs"), lambda x: judge.accepts(x["v"]))
    more = F.when(F.size("__runs") > 0, F.array_sort(F.concat("__base", extra))).otherwise(F.col("__base"))
    return found.withColumn("spans", more)


def find(docs: DataFrame, text: str = "text", alpha: float = 0.01, random_p: float = 0.01) -> DataFrame:
    """``docs`` with ``spans``: array of (s, e, kind, v); kind indexes ``KINDS``.

    Texts are scanned for the statistics and again for the result, which costs
    less than writing them.
    """
    found = scanned(docs, text)
    judge = learn(found.select(F.explode("__runs.v").alias("v")), language(docs, text), alpha, random_p)
    return accepted(found, judge).drop("__base", "__runs")


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", **settings) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mask``; null texts stay null."""
    found = find(docs, text, **settings)
    body = F.col(text)

    def cut(spans):
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

        def step(a, x):
            fresh = F.concat(a["out"], F.substring(body, (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int")), F.lit(mask))
            return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], fresh).otherwise(a["out"]).alias("out"))

        return F.aggregate(spans, start, step, lambda a: F.concat(
            a["out"], F.substring(body, (a["at"] + 1).cast("int"), F.length(body))))

    clean = F.when(F.size("spans") > 0, cut(F.col("spans"))).otherwise(body)
    return found.withColumn(text, clean).drop("spans")
