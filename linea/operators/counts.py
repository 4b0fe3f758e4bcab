"""Count tables that merge: a step adds its own lines' counts to those of the step before.

Truecasing (``lc, w, cnt``), dictionaries (``token, cnt``) and collocations
(``w, c`` and ``w1, w2, cnt``) are learned from sums over lines, so the table of
all lines is the sum of the tables of any parts. What a step reads is its own
lines and the count table, not the lines of earlier steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged(tables: list[DataFrame], count: str = "cnt") -> DataFrame:
    """The count table of all parts' lines: keys are all columns but ``count``."""
    keys = [c for c in tables[0].columns if c != count]
    both = reduce(DataFrame.unionByName, tables)
    return both.groupBy(*keys).agg(F.sum(count).cast("bigint").alias(count))


def without(table: DataFrame, part: DataFrame, count: str = "cnt") -> DataFrame:
    """The count table after a part's lines are taken away; a count that would fall below zero raises."""
    left = merged([table, part.withColumn(count, -F.col(count))], count)
    err = F.raise_error(F.lit("the part's lines are not in the table")).cast("bigint")
    return left.where(F.col(count) != 0).withColumn(count, F.when(F.col(count) < 0, err).otherwise(F.col(count)))
