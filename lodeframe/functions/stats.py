"""Statistical measures as aggregate columns, and grade ladders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodeframe.functions.scalars import Col, col

#: (at most, or at least) -> grade; fixed values.
GRADE_ERROR = ((10, "A"), (20, "B"), (35, "C"), (50, "D"))
GRADE_ERROR_STRICT = ((15, "A"), (25, "B"), (40, "C"), (60, "D"))
GRADE_HEALTH = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
GRADE_SCORE = ((80, "A"), (65, "B"), (50, "C"), (35, "D"))
GRADE_CONSENSUS = ((75, "A"), (55, "B"), (35, "C"), (20, "D"))
GRADE_POPULATION = ((95, "A"), (80, "B"), (60, "C"), (40, "D"))


def _ladder(tests: Sequence[tuple[Column, str]], value: Column) -> Column:
    out = F.when(value.isNull(), "N/A")
    for test, grade in tests:
        out = out.when(test, grade)
    return out.otherwise("F")


def grade_up_to(value: Col, steps: Sequence[tuple[float, str]] = GRADE_ERROR) -> Column:
    return _ladder([(col(value) <= x, g) for x, g in steps], col(value))


def grade_below(value: Col, steps: Sequence[tuple[float, str]] = GRADE_ERROR_STRICT) -> Column:
    return _ladder([(col(value) < x, g) for x, g in steps], col(value))


def grade_from(value: Col, steps: Sequence[tuple[float, str]] = GRADE_SCORE) -> Column:
    return _ladder([(col(value) >= x, g) for x, g in steps], col(value))


def both_positive(a: Col, b: Col) -> Column:
    """Both are numbers above 0; NaN is not."""
    return F.coalesce((col(a) > 0) & (col(b) > 0) & ~F.isnan(col(a)) & ~F.isnan(col(b)), F.lit(False))


def _of(test: Column, value: Column) -> Column:
    return F.when(test, value)


def _pearson(x: Column, y: Column) -> Column:
    """Correlation of pairs; null, not an error, where a side does not vary. x and y must be null together."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def accuracy(actual: Col, predicted: Col, least: int = 5) -> dict[str, Column]:
    """n, mape, mae, bias, bias_pct, rmse and r over pairs above 0; null below `least` pairs."""
    a, p = col(actual), col(predicted)
    ok = both_positive(a, p)
    n = F.count_if(ok)
    enough = n >= least
    d = p - a
    flat = (F.stddev_pop(_of(ok, a)) == 0) | (F.stddev_pop(_of(ok, p)) == 0)
    return {
        "n": n, "mape": F.when(enough, F.avg(_of(ok, F.abs(d) / a)) * 100), "mae": F.when(enough, F.avg(_of(ok, F.abs(d)))), "bias": F.when(enough, F.avg(_of(ok, d))),
        "bias_pct": F.when(enough, F.avg(_of(ok, d)) / F.avg(_of(ok, a)) * 100), "rmse": F.when(enough, F.sqrt(F.avg(_of(ok, d * d)))),
        "r": F.when(enough & (n > 2) & ~flat, _pearson(_of(ok, a), _of(ok, p))),
    }


def correlation(a: Col, b: Col) -> Column:
    """Pearson's r: null below two pairs, 0 where a side does not vary."""
    ok = col(a).isNotNull() & col(b).isNotNull()
    x, y = _of(ok, col(a)), _of(ok, col(b))
    flat = (F.stddev_pop(x) == 0) | (F.stddev_pop(y) == 0)
    return F.when(F.count(x) < 2, None).when(flat, 0.0).otherwise(_pearson(x, y))


def mape_symmetric(a: Col, b: Col) -> Column:
    ok = both_positive(a, b)
    return F.avg(_of(ok, F.abs(col(a) - col(b)) / F.greatest(col(a), col(b)))) * 100


def bias_of_sums(a: Col, b: Col) -> Column:
    ok = both_positive(a, b)
    return F.sum(_of(ok, col(a) - col(b))) / F.sum(_of(ok, col(b))) * 100


def cv_absolute(delta: Col) -> Column:
    """Variation of |delta|: null below two, 0 where its mean is 0."""
    d = F.abs(col(delta))
    return F.when(F.count(d) < 2, None).when(F.avg(d) == 0, 0.0).otherwise(F.stddev_pop(d) / F.avg(d) * 100)


def cv_signed(delta: Col) -> Column:
    d = col(delta)
    return F.when(F.count(d) < 2, None).when(F.avg(F.abs(d)) == 0, 0.0).otherwise(F.stddev_pop(d) / F.avg(F.abs(d)) * 100)


def agreement(pct: Col, below: float = 20.0) -> Column:
    return F.coalesce(F.avg(F.when(col(pct) < below, 1.0).when(col(pct).isNotNull(), 0.0)) * 100, F.lit(0.0))


def distances(value: Col, accuracy: int | None = None) -> dict[str, Column]:
    """Count, spread and percentiles. One exact percentile of all fractions; with accuracy, an approximate one of bounded memory."""
    v = col(value)
    fractions = F.array(*map(F.lit, (0.10, 0.25, 0.50, 0.75, 0.90)))
    every = F.percentile_approx(v, fractions, accuracy) if accuracy else F.percentile(v, fractions)
    q = lambda p: every[{0.10: 0, 0.25: 1, 0.50: 2, 0.75: 3, 0.90: 4}[p]]
    return {
        "n": F.count(v), "least": F.min(v), "p10": q(0.10), "p25": q(0.25), "median": q(0.50), "p75": q(0.75), "p90": q(0.90), "largest": F.max(v), "mean": F.avg(v),
        "std": F.stddev_samp(v), "iqr": q(0.75) - q(0.25),
    }


def within(value: Col, limits: Sequence[float] = (100, 500, 1000, 5000)) -> dict[str, Column]:
    return {f"within_{x:g}": F.count_if(col(value) <= x) for x in limits}


def bands(value: Col) -> dict[str, Column]:
    """Counts below 1 km, from 1 to 3 km, and from 3 to 5 km inclusive."""
    v = col(value)
    return {"under_1km": F.count_if(v < 1000), "from_1_to_3km": F.count_if((v >= 1000) & (v < 3000)), "from_3_to_5km": F.count_if((v >= 3000) & (v <= 5000))}


def delta(a: Col, b: Col, pct_from: float = 20.0, abs_from: float = 10.0) -> dict[str, Column]:
    """delta, percent of the larger, and whether it is significant; null counts as 0."""
    x, y = F.coalesce(col(a), F.lit(0.0)), F.coalesce(col(b), F.lit(0.0))
    top = F.greatest(x, y)
    pct = F.when(top > 0, F.abs(x - y) / top * 100).otherwise(0.0)
    return {"delta_mw": x - y, "delta_pct": pct, "significant": (pct >= pct_from) | (F.abs(x - y) >= abs_from)}


def histogram_bin(value: Col, edges: Sequence[float]) -> Column:
    """Number of the half-open bin, from 0; null outside all."""
    v = col(value)
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        out = F.when((v >= edges[i]) & (v < edges[i + 1]), F.lit(i)).otherwise(out)
    return out


def spatial_score(recall: Col, median: Col) -> Column:
    near = F.when(col(median) > 0, F.least(F.lit(100.0), F.greatest(F.lit(0.0), 100 - col(median) / 100))).otherwise(0.0)
    return F.coalesce(col(recall), F.lit(0.0)) * 0.5 + near * 0.5


def tier_weighted(tier_value: Sequence[tuple[Col, float]]) -> Column:
    """Mean of the tiers that have a value, weights renormalised."""
    top = sum((F.coalesce(col(v) * w, F.lit(0.0)) for v, w in tier_value), F.lit(0.0))
    weight = sum((F.when(col(v).isNotNull(), F.lit(w)).otherwise(0.0) for v, w in tier_value), F.lit(0.0))
    return F.when(weight > 0, top / weight)
