"""Simple linear regression: fitted once, or with every point in turn.

A fit is undefined with fewer than two points or with only one distinct x; it is NULL then.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagpulse.operators.ordering import running

SUMS = ["n", "x", "y", "xx", "xy"]


def fit(points: DataFrame, x, y) -> DataFrame:
    """One row (slope, intercept, points). The built-in moments are centred, so they do not cancel."""
    return points.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("points"))


def score(cells: DataFrame, model: DataFrame, x) -> DataFrame:
    """Adds `prediction`. The one-row model is a scalar subquery: computed once, no join."""
    line = model.select(F.struct("slope", "intercept")).scalar()
    return cells.withColumn("prediction", line["intercept"] + line["slope"] * F.col(x))


def _terms(cells: DataFrame, x, y, xy) -> dict[str, Column]:
    """What each point adds to the five sums. Integers are summed as decimals, exactly."""
    exact = T.DecimalType(19, 0)
    whole = isinstance(cells.schema[y].dataType, T.IntegralType)
    ex = F.col(x).cast(exact)
    why = F.col(y).cast(exact) if whole else F.col(y)
    if xy is not None:
        product = F.col(xy).cast(exact)
    else:
        product = ex * why if whole else F.col(x).cast("double") * why
    return {"n": F.lit(1).cast(exact), "x": ex, "y": why, "xx": ex * ex, "xy": product}


def _cross(n, ab, a, b) -> Column:
    """n·Σab − Σa·Σb. Of whole numbers it is exact, in decimals of 38 digits; sums whose products need more stop the query.
    Of fractions it is a double."""
    return (F.col(n) * F.col(ab) - F.col(a) * F.col(b)).cast("double")


def online_predictions(cells: DataFrame, x, y, xy=None, order=("window_start", "tag"), before=None, ranges=None) -> DataFrame:
    """Adds `prediction` at each cell by the line through all cells up to and including it, in
    `order`; cells where that line is undefined are dropped.

    The fit is a function of five sums, so it is a running total over all cells (ordering.py)
    and needs no single task. `xy` names a column that already holds x·y. `before` holds the
    sums of earlier cells, as `point_sums` gives them.
    """
    terms = _terms(cells, x, y, xy)
    summed = running(cells, [], order, {f"_{n}": c for n, c in terms.items()}, ranges=ranges)
    if before is not None:
        summed = summed.withColumns({
            f"_{n}": F.col(f"_{n}") + F.lit(before[n]).cast(summed.schema[f"_{n}"].dataType) for n in SUMS})
    slope = _cross("_n", "_xy", "_x", "_y") / F.nullif(_cross("_n", "_xx", "_x", "_x"), F.lit(0.0))
    d = lambda c: F.col(c).cast("double")
    return (
        summed.withColumn("_slope", slope)
        .withColumn("_intercept", (d("_y") - F.col("_slope") * d("_x")) / d("_n"))
        .withColumn("prediction", F.col("_intercept") + F.col("_slope") * F.col(x))
        .where(F.col("prediction").isNotNull())
        .select(*cells.columns, "prediction")
    )


def point_sums(cells: DataFrame, x, y, xy=None) -> DataFrame:
    """One row with the five sums (n, x, y, xx, xy); zeros if there are no cells."""
    terms = _terms(cells, x, y, xy)
    sums = cells.agg(*[F.sum(c).alias(n) for n, c in terms.items()])
    return sums.select(*[F.coalesce(n, F.lit(0).cast(sums.schema[n].dataType)).alias(n) for n in SUMS])
