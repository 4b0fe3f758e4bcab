"""Document fingerprints by Order MinHash.

A text is a sequence of words; its k-mers are its runs of ``k`` words. Equal
k-mers are told apart by their occurrence number. One hash of (k-mer,
occurrence) deals the pairs to ``sketches`` bins and orders them; a bin takes
its ``tuple_size`` least pairs (from the following bins where it has fewer),
puts them back into the order of the text and hashes the tuple to 32 bits. A
fingerprint is those numbers in hex. Likeness of two fingerprints is the share
of equal numbers: tuples agree if the same k-mers are least and stand in the
same order, which edits that move or change text break.

Main path: DataFrame functions only, one row at a time, no shuffle. Numbers of
k-mers are packed with positions (34 and 30 bits) into one long, so that both
sorts of a text are sorts of longs.

Edge cases: null or empty text, or only white space, has the fingerprint of no
k-mers; fewer than ``k`` words are one k-mer. Very long texts are read whole
(up to 2^30 words). Equal texts have equal fingerprints. Other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.llm.common import let, materialise
from linea.operators.positional import ordered_index

POSITION = (1 << 30) - 1


def _pack(h: Column, at: Column) -> Column:
    """Upper 34 bits of a hash and a position."""
    return h.bitwiseAND(F.lit(~POSITION)).bitwiseOR(at)


def _upper(x: Column) -> Column:
    return F.shiftright(x, 30)


def _starts(values: Column, key) -> Column:
    """Indices at which the key of a sorted array changes."""
    return F.filter(F.sequence(F.lit(0), F.size(values) - 1),
                    lambda i: (i == 0) | (key(F.get(values, i)) != key(F.get(values, i - 1))))


def kmers(text: Column, k: int) -> Column:
    """Hash of each k-mer in text order."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(h):
        run = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0))), run)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def numbered(hashes: Column) -> Column:
    """Sorted longs of (hash of k-mer and occurrence number, position)."""
    def renumber(s):
        # equal k-mers lie side by side in text order: a pair's occurrence number is its distance from the first
        def occurrences(first):
            def one(begin, j):
                end = F.coalesce(F.get(first, j + 1), F.size(s)) - 1
                return F.transform(F.sequence(begin, end), lambda i: _pack(
                    F.xxhash64(_upper(F.get(s, i)), i - begin), F.get(s, i).bitwiseAND(F.lit(POSITION))))
            return F.flatten(F.transform(first, one))
        return let(_starts(s, _upper), occurrences)

    packed = F.sort_array(F.transform(hashes, lambda h, i: _pack(h, i.cast("bigint"))))
    return F.when(F.size(hashes) == 0, hashes).otherwise(F.sort_array(let(packed, renumber)))


def signature(pairs: Column, sketches: int, tuple_size: int) -> Column:
    """Array of ``sketches`` numbers of 32 bits."""
    shift = 64 - (sketches.bit_length() - 1)
    half = sketches // 2  # the sign bit: bins run from -half to half - 1

    def of(s):
        def tuples(first):
            # (bin, index of its least pair) of the bins that have any
            held = F.transform(first, lambda i: F.struct(F.shiftright(F.get(s, i), shift).cast("int").alias("b"), i.alias("i")))

            def one(bins):
                def number(b):
                    at = F.coalesce(F.get(F.filter(bins, lambda x: x["b"] >= b), F.lit(0))["i"], F.lit(0))
                    took = F.transform(F.sequence(F.lit(0), F.least(F.lit(tuple_size), F.size(s)) - 1),
                                       lambda j: F.get(s, (at + j) % F.size(s)))
                    in_text = F.array_sort(F.transform(took, lambda x: F.struct(x.bitwiseAND(F.lit(POSITION)).alias("p"),
                                                                                _upper(x).alias("h"))))
                    return F.shiftright(F.xxhash64(F.transform(in_text, lambda x: x["h"])), 32).cast("int")
                return F.transform(F.sequence(F.lit(-half), F.lit(half - 1)), number)
            return let(held, one)
        return let(_starts(s, lambda x: F.shiftright(x, shift)), tuples)

    none = F.array_repeat(F.lit(0), sketches)
    return let(pairs, lambda s: F.when(F.size(s) == 0, none).otherwise(of(s)))


def fingerprint(text: Column, k: int = 2, sketches: int = 32, tuple_size: int = 2) -> Column:
    """Order MinHash numbers of a text column (``sketches`` is a power of two)."""
    return signature(numbered(kmers(F.coalesce(text, F.lit("")), k)), sketches, tuple_size)


def told(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda x: F.lpad(F.lower(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal numbers of two fingerprints."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return same / F.size(a).cast("double")


def neighbours(prints: DataFrame) -> DataFrame:
    """``prints`` (id, h, n, fp; one row for each different (id, h)) with the next row's fingerprint
    ``next_fp`` and the key and size of the row before (pid, ph, pn), in order of id and h, in a ring."""
    order = [F.col("id").asc_nulls_first(), F.col("h").asc()]
    ranked = ordered_index(prints, order, "rank")
    ranked = materialise(ranked)
    size = max(1, ranked.count())
    after = ranked.select(F.pmod(F.col("rank") - 1, F.lit(size)).alias("rank"), F.col("fp").alias("next_fp"))
    before = ranked.select(F.pmod(F.col("rank") + 1, F.lit(size)).alias("rank"), F.col("id").alias("pid"),
                           F.col("h").alias("ph"), F.col("n").alias("pn"))
    return ranked.join(after, "rank").join(before, "rank").drop("rank")


def edited(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(id, n, fp, text, edited, next_fp): every row with its text whose last quarter is the beginning of the
    next document's, in order of id (equal ids by a hash of the text; equal rows count once and share the result).

    Texts are shuffled once, to meet the key and size of the document before;
    from there only the needed beginnings travel.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text", F.lit(13)))
    prints = materialise(rows.select("id", "h", F.length("text").cast("bigint").alias("n"),
                                     fingerprint(F.col("text"), **settings).alias("fp")))
    counted = prints.groupBy("id", "h").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.count(F.lit(1)).alias("copies"))
    ring = materialise(neighbours(counted))
    key = ring.withColumnsRenamed({"id": "i", "h": "g"})
    placed = rows.join(key, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g"))).drop("i", "g")
    head = F.substring(F.col("text"), F.lit(1), F.floor(F.col("pn") / 4).cast("int")).alias("head")
    heads = placed.where("copies = 1").select("pid", "ph", head)
    if not ring.where("copies > 1").isEmpty():
        heads = heads.unionByName(placed.where("copies > 1").dropDuplicates(["id", "h"]).select("pid", "ph", head))
    both = placed.drop("pid", "ph", "pn").join(heads, F.col("id").eqNullSafe(F.col("pid")) & (F.col("h") == F.col("ph")))
    stays = (F.col("n") - F.floor(F.col("n") / 4)).cast("int")
    changed = F.concat(F.substring(F.col("text"), F.lit(1), stays), F.col("head"))
    return both.select("id", "n", "fp", "text", changed.alias("edited"), "next_fp")
