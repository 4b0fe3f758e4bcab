"""Line-pair metrics: exact match, accuracy, Pearson correlation.

Every metric is a sum of per-line statistics followed by a scalar formula, so
the global aggregate is partial (map side) + one tiny final stage, and the
same statistics feed the bootstrap in :mod:`linea.operators.bootstrap`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.functions.text import strip_unicode


def exact_match(df: DataFrame, a: str, b: str) -> DataFrame:
    """``matches, lines, accuracy`` (percent, 2 decimals; NULL on no lines)."""
    eq = (F.col(a) == F.col(b)).cast("bigint")
    return df.agg(F.sum(eq).cast("bigint").alias("matches"), F.count(F.lit(1)).alias("lines")) \
        .select("matches", "lines",
                F.round(F.try_divide(100 * F.col("matches"), F.col("lines")), 2).alias("accuracy"))


def accuracy_stat(gold: str, sys: str) -> Column:
    """Per-line statistic of E7: 1 when the stripped strings are equal."""
    return (strip_unicode(F.col(gold)) == strip_unicode(F.col(sys))).cast("double")


def accuracy(df: DataFrame, gold: str, sys: str) -> DataFrame:
    """Share of equal labels (0-1)."""
    return df.agg(F.avg(accuracy_stat(gold, sys)).alias("accuracy"))


def pearson_from_sums(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Correlation from (centred) sums; NULL when a variance is zero."""
    cov = n * sxy - sx * sy
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    return F.try_divide(cov, F.sqrt(vx * vy))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation from the built-in (numerically stable, one-pass,
    partially aggregated) population moments; zero variance gives NULL."""
    return df.agg(F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y))).alias("pearson"))


def centred_moments(df: DataFrame, x: str, y: str) -> DataFrame:
    """Per-line additive statistics of the Pearson coefficient, centred on the
    global means (one scalar aggregate, then a narrow projection)."""
    mx, my = df.agg(F.avg(x), F.avg(y)).first()
    cx, cy = F.col(x) - F.lit(mx), F.col(y) - F.lit(my)
    return df.select("*", cx.alias("px"), cy.alias("py"), (cx * cx).alias("pxx"),
                     (cy * cy).alias("pyy"), (cx * cy).alias("pxy"))
