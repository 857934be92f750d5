"""Preparing model inputs: filling gaps, power transform, scaling."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.functions.columns import yeo_johnson
from pitfeat.operators.profile import exact_quantiles, unpivot


#: grids that a power fit moves on by before it says that it found no top
MOVES = 50


def impute_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls with the column mean."""
    means = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns])
    return _fill_from(df.crossJoin(F.broadcast(means)), columns)


def impute_group_median(
    df: DataFrame, columns: list[str], by: list[str], **how
) -> DataFrame:
    """Fill nulls with the median of the row's group, or else of the whole column.

    This stands in for nearest-neighbour filling: rows of one group are the
    neighbours, and no pair of rows is ever compared.
    """
    half = {"q": 0.5}

    def medians(keys, suffix):
        long = unpivot(df, keys, columns)
        q = exact_quantiles(long, [*keys, "column"], "value", half, **how)
        pick = [
            F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"{suffix}{c}") for c in columns
        ]
        return q.groupBy(*keys).agg(*pick) if keys else q.agg(*pick)

    d = df.join(medians(by, "_g_"), by, "left") if by else df
    d = d.crossJoin(F.broadcast(medians([], "_a_")))
    d = d.withColumns(
        {
            f"_m_{c}": F.coalesce(f"_g_{c}", f"_a_{c}") if by else F.col(f"_a_{c}")
            for c in columns
        }
    )
    return _fill_from(d, columns).select(*df.columns)


def _fill_from(d: DataFrame, columns: list[str]) -> DataFrame:
    d = d.withColumns({c: F.coalesce(F.col(c).cast("double"), f"_m_{c}") for c in columns})
    return d.drop(*[f"_m_{c}" for c in columns])


def fit_power(df: DataFrame, columns: list[str], lo: float = -3.0, hi: float = 3.0) -> dict[str, float]:
    """Lambda of each column by maximum likelihood, to three decimals.

    A pass evaluates a whole grid of lambdas for all columns as one aggregate;
    three passes narrow the grid, and one more follows while a best point lies on an
    edge. Only the grid's likelihoods reach the driver.
    """
    best = {c: (lo + hi) / 2 for c in columns}
    reach = (hi - lo) / 2
    steps, moves = [0.2, 0.02, 0.001], 0
    while steps:
        step, edge = steps[0], set()
        points = round(reach / step)
        grid = {
            c: [round(best[c] + i * step, 6) for i in range(-points, points + 1)] for c in columns
        }
        aggs = []
        for c in columns:
            x = F.col(c).cast("double")
            jacobian = F.sum(F.signum(x) * F.log1p(F.abs(x)))
            aggs.append(F.struct(F.count(x), jacobian).alias(f"_{c}"))
            for i, g in enumerate(grid[c]):
                aggs.append(F.var_pop(yeo_johnson(x, g)).alias(f"_{c}_{i}"))
        row = df.agg(*aggs).first()
        for c in columns:
            n, jacobian = row[f"_{c}"]

            def likelihood(i):
                var = row[f"_{c}_{i}"]
                if not n or not var or math.isnan(var) or math.isinf(var):
                    return -math.inf
                return -n / 2 * math.log(var) + (grid[c][i] - 1) * jacobian

            scores = [likelihood(i) for i in range(len(grid[c]))]
            top = max(range(len(scores)), key=scores.__getitem__)
            best[c] = grid[c][top] if scores[top] > -math.inf else 1.0
            if scores[top] > -math.inf and top in (0, len(scores) - 1):
                edge.add(c)
        # a best point on the edge of a grid may not be the best: go on from there
        if edge and moves < MOVES:
            moves += 1
        else:
            if edge:
                warnings.warn(f"the likelihood of {sorted(edge)} still rises at the edge of its grid", stacklevel=2)
            steps.pop(0)
            reach = step
    return best


def power_transform(df: DataFrame, lambdas: dict[str, float], scale: bool = True) -> DataFrame:
    """Apply the power transform, then centre and scale to unit variance."""
    d = df.withColumns({c: yeo_johnson(c, g) for c, g in lambdas.items()})
    return standardise(d, list(lambdas)) if scale else d


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns],
    )
    d = df.crossJoin(F.broadcast(stats))

    def scaled(c):
        s = F.col(f"_s_{c}")
        return (F.col(c) - F.col(f"_m_{c}")) / F.when(s == 0, 1.0).otherwise(s)

    d = d.withColumns({c: scaled(c) for c in columns})
    return d.drop(*[f"_{p}_{c}" for p in "ms" for c in columns])


def to_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse text as double; what does not parse becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})
