"""Mixing sources to target weights by capped water-filling.

A source's target is ``least(max_epochs * size, level * weight)``: sources that
the level carries over their cap are clamped, and the excess is shared among
the others by weight until none is above. The level is found over one row per
source, ordered by cap / weight, from prefix sums of caps and weights.

A target of e epochs repeats each row floor(e) times; the remaining words come
from the rows in the order of a seeded hash until the remainder is met, the
last of them in part, so that a source's words equal its target to a word. To
find that last row without ordering a source, sizes are summed per source and
256 hash cells, then per 256 cells of the crossing one; only rows of the
crossing cell (about one in 65,536 of a source) are ordered.

Main path: DataFrame functions only. Edge cases: null or empty text has size
0; a source without words has target 0; a null source is a source of its own,
ordered last. Repeated rows are taken one by one. Empty tables give an empty
result. Other columns pass through; the operator's own names start with two
underscores, which are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linea.llm.common import WORD, materialise

#: Plans of up to so many sources are sent to every task; a larger one is joined by shuffling.
BROADCAST_SOURCES = 100_000
#: Columns that ``allot`` adds.
ADDED = ["size", "source_size", "target", "taken"]


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 42) -> DataFrame:
    """``docs`` with size in words, seeded hash and its two cells."""
    h = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text))
    return (docs.withColumn("__size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint"))
            .withColumn("__h", h)
            .withColumn("__b1", F.shiftrightunsigned("__h", 56).cast("int"))
            .withColumn("__b2", F.shiftrightunsigned("__h", 48).cast("int").bitwiseAND(255)))


def water_fill(sizes: DataFrame, source: str, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source."""
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("r").cast("int"))
    rows = (sizes.withColumn("r", (F.row_number().over(by_name) - 1) % len(weights) + 1)
            .withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
            .withColumn("ratio", F.col("cap") / F.col("w")))
    # over the sources in order of cap / weight: what the earlier ones hold when clamped, and the weights left
    order = Window.orderBy("ratio", F.col(source).asc_nulls_last())
    rows = (rows.withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
            .withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("n", F.row_number().over(order))
            .withColumn("level", (F.col("total") - F.col("before")) / F.col("left")))
    free = F.when(F.col("ratio") > F.col("level"), F.struct("n", "level"))
    rows = rows.withColumn("level", F.min(free).over(Window.partitionBy())["level"])
    return rows.select(source, "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), "cap")).alias("target"))


def plan(measured: DataFrame, source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
         max_epochs: float = 2.0) -> DataFrame:
    """One row per source: size, target, whole repetitions, remaining words and the cell where they end."""
    cells = materialise(measured.groupBy(F.col(source).alias("s"), "__b1", "__b2").agg(F.sum("__size").alias("n")))
    sizes = cells.groupBy("s").agg(F.sum("n").alias("source_size"))
    targets = (water_fill(sizes, "s", weights, share, max_epochs)
               .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.round(F.col("target"))
                                                                          / F.col("source_size"))).otherwise(0))
               .withColumn("rest", F.round("target").cast("bigint") - F.col("whole") * F.col("source_size")))
    targets = materialise(targets)

    def crossing(sums: DataFrame, cell: str, start) -> DataFrame:
        """Of each source's cells in order, the one in which the remaining words end."""
        upto = F.sum("n").over(Window.partitionBy("s").orderBy(cell)) + start
        return (sums.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("n"))
                .where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("upto"))))

    first = cells.groupBy("s", "__b1").agg(F.sum("n").alias("n"))
    first = first.join(targets.select(F.col("s").alias("t"), "rest"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    first = crossing(first, "__b1", F.lit(0)).select(F.col("s").alias("t"), "rest", F.col("__b1").alias("c1"),
                                                     F.col("start").alias("start1"))
    second = cells.join(first, F.col("s").eqNullSafe(F.col("t")) & (F.col("__b1") == F.col("c1"))).drop("t")
    second = crossing(second, "__b2", F.col("start1")).select(F.col("s").alias("t"), "c1", F.col("__b2").alias("c2"),
                                                              F.col("start").alias("start2"))
    return targets.join(second, F.col("s").eqNullSafe(F.col("t")), "left").drop("t")


def _taken(measured: DataFrame, planned: DataFrame, id_col: str, source: str) -> DataFrame:
    p = planned.select(F.col("s").alias("__s"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                       F.col("whole").alias("__whole"), F.col("rest").alias("__rest"), F.col("c1").alias("__c1"),
                       F.col("c2").alias("__c2"), F.col("start2").alias("__start"))
    rows, names = planned.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("s")), F.lit(0))).first()
    if rows <= BROADCAST_SOURCES and names <= 64 << 20:  # a row of ten numbers and a name for each source
        p = F.broadcast(p)
    rows = measured.join(p, F.col(source).eqNullSafe(F.col("__s"))).drop("__s")
    cell, edge = F.struct("__b1", "__b2"), F.struct("__c1", "__c2")
    at_edge = F.coalesce(cell == edge, F.lit(False))
    plain = rows.where(~at_edge).withColumn("__more", F.when(F.coalesce(cell < edge, F.lit(False)), F.col("__size")).otherwise(0))
    order = Window.partitionBy(source).orderBy("__h", id_col, "__size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__start") + F.coalesce(F.sum("__size").over(order), F.lit(0))
    edged = rows.where(at_edge).withColumn("__more", F.least(F.col("__size"), F.greatest(F.col("__rest") - before, F.lit(0))))
    return plain.unionByName(edged).withColumn("__taken", F.col("__whole") * F.col("__size") + F.col("__more"))


def allot(measured: DataFrame, planned: DataFrame, id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """``measured`` with size, source_size, target and taken (words, repeats counted) for every row.

    These four replace columns of the same names.
    """
    both = _taken(measured, planned, id_col, source)
    both = both.withColumns({c: F.col(f"__{c}").cast("double" if c == "target" else "bigint") for c in ADDED})
    return both.drop(*[c for c in both.columns if c.startswith("__")])


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The mixed rows: every column of ``docs``, a row for each repetition; a part holds the first words of its text."""
    measured = measure(docs, id_col, text)
    planned = plan(measured.select(source, "__size", "__b1", "__b2"), source, **settings)
    rows = _taken(measured, materialise(planned), id_col, source)
    part = F.col("__taken") % F.col("__size")
    copies = F.flatten(F.array(F.array_repeat(F.lit(0), (F.col("__taken") / F.col("__size")).cast("int")),
                               F.when(part > 0, F.array(part.cast("int"))).otherwise(F.array().cast("array<int>"))))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.lit(1), F.col("__copy")), " ")
    rows = rows.where("__taken > 0").withColumn("__copy", F.explode(copies))
    rows = rows.withColumn(text, F.when(F.col("__copy") == 0, F.col(text)).otherwise(cut))
    return rows.select(*docs.columns)
