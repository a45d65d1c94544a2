"""Property and token distributions: statistics, bounds, filters and the removal funnel."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.columns import failure_reasons, known_tokens, no_nan, no_rare_tokens, within


@dataclass(frozen=True)
class Threshold:
    """Bounds of a property: absolute ones win over multiples of the standard deviation, those over quantiles."""

    min_value: float | None = None
    max_value: float | None = None
    statistical_lower: float | None = None
    statistical_upper: float | None = None
    quantile_lower: float | None = None
    quantile_upper: float | None = None

    def __post_init__(self):
        for low, high in (("min_value", "max_value"), ("statistical_lower", "statistical_upper"), ("quantile_lower", "quantile_upper")):
            a, b = getattr(self, low), getattr(self, high)
            if a is not None and b is not None and a >= b:
                raise ValueError(f"{low} must be below {high}")
        for q in (self.quantile_lower, self.quantile_upper):
            if q is not None and not 0 <= q <= 1:
                raise ValueError("quantiles lie between 0 and 1")


def statistics(df: DataFrame, properties: Iterable[str]) -> DataFrame:
    """One row for each property: count, mean, std, min, max, median, skew, kurtosis, halves to even at two digits."""
    properties = list(properties)
    aggs = []
    for p in properties:
        c = no_nan(F.col(p))
        digits = lambda e: F.bround(e, 2)
        aggs.append(F.struct(F.lit(p).alias("property"), F.count(c).alias("count"), digits(F.avg(c)).alias("mean"), digits(F.stddev_samp(c)).alias("std"), digits(F.min(c)).alias("min"), digits(F.max(c)).alias("max"), digits(F.percentile(c, 0.5)).alias("median"), digits(F.skewness(c)).alias("skew"), digits(F.kurtosis(c)).alias("kurtosis")))
    return df.agg(F.array(*aggs).alias("all")).select(F.explode("all").alias("s")).select("s.*")


def bounds(df: DataFrame, thresholds: Mapping[str, Threshold], signed: Iterable[str] = ("logp",)) -> dict[str, tuple[float | None, float | None]]:
    """Limits of each property as numbers, from one aggregate over the data; unsigned properties have none below 0."""
    wanted = [q for t in thresholds.values() for q in (t.quantile_lower, t.quantile_upper) if q is not None]
    exprs: list[Column] = []
    for i, (p, t) in enumerate(thresholds.items()):
        c = no_nan(F.col(p))
        exprs += [F.bround(F.avg(c), 2).alias(f"mean{i}"), F.bround(F.stddev_samp(c), 2).alias(f"std{i}")]
        exprs += [F.percentile(c, q).alias(f"q{i}_{side}") for side, q in (("low", t.quantile_lower), ("high", t.quantile_upper)) if q is not None]
    needs = wanted or any(t.statistical_lower is not None or t.statistical_upper is not None for t in thresholds.values())
    row = df.agg(*exprs).first() if needs else None
    out = {}
    for i, (p, t) in enumerate(thresholds.items()):
        sides = [_bound(row, i, "low", t.min_value, t.statistical_lower, t.quantile_lower), _bound(row, i, "high", t.max_value, t.statistical_upper, t.quantile_upper)]
        out[p] = tuple(x if x is None or p in set(signed) else max(0.0, x) for x in sides)
    return out


def _bound(row: Row | None, i: int, side: str, absolute, statistical, quantile) -> float | None:
    if absolute is not None:
        return float(absolute)
    if statistical is not None:
        mean, std = row[f"mean{i}"], row[f"std{i}"]
        return None if mean is None or std is None else mean + statistical * std
    return row[f"q{i}_{side}"] if quantile is not None else None


def normality(n: int, skew: float | None, kurtosis: float | None) -> dict:
    """D'Agostino-Pearson from count, skewness and excess kurtosis; the two-degree chi-square tail is exp(-K2/2)."""
    out = {"p_value": None, "normal": None, "practically_normal": None}
    if skew is None or kurtosis is None or math.isnan(skew) or math.isnan(kurtosis):
        return out
    out["practically_normal"] = abs(skew) < 1 and abs(kurtosis) < 2
    if n < 8:
        return out
    y = skew * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    b2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (b2 - 1))
    a = math.sqrt(2 / (w2 - 1))
    z1 = math.asinh(y / a) / math.sqrt(0.5 * math.log(w2))
    mean, var = 3.0 * (n - 1) / (n + 1), 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3.0) * (n + 5))
    x = (kurtosis + 3 - mean) / math.sqrt(var)
    root_b1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    df = 6 + 8 / root_b1 * (2 / root_b1 + math.sqrt(1 + 4 / root_b1**2))
    spread = 1 + x * math.sqrt(2 / (df - 4))
    cube = math.copysign(((1 - 2 / df) / abs(spread)) ** (1 / 3), spread) if spread else 0.0
    z2 = (1 - 2 / (9 * df) - cube) / math.sqrt(2 / (9 * df))
    out["p_value"] = math.exp(-(z1 * z1 + z2 * z2) / 2)
    out["normal"] = out["p_value"] >= 0.05
    return out


def token_frequency(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Rows that hold each token, and their share of all rows in percent."""
    total = df.agg(F.count("*").alias("total"))
    held = df.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return held.crossJoin(F.broadcast(total)).select("token", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("percent"))


def curate(df: DataFrame, limits: Mapping[str, tuple[float | None, float | None]], vocabulary: Iterable[str] | None = None, rare: Iterable[str] = (), drop: bool = True) -> DataFrame:
    """Flag rows (properties_ok, tokens_ok, success, failures) and, with drop, keep those that pass."""
    ok = F.lit(True)
    for name, (low, high) in limits.items():
        ok = ok & within(F.col(name), low, high) if low is not None or high is not None else ok
    known = known_tokens(F.col("tokens"), vocabulary) if vocabulary is not None else F.lit(True)
    common = no_rare_tokens(F.col("tokens"), rare)
    flagged = df.withColumns({"properties_ok": ok, "tokens_ok": known & common, "failures": failure_reasons(limits, ~known if vocabulary is not None else None, ~common if list(rare) else None)})
    flagged = flagged.withColumn("success", F.col("properties_ok") & F.col("tokens_ok"))
    return flagged.where("success") if drop else flagged


def funnel(flagged: DataFrame) -> DataFrame:
    """Rows removed by property, by token among those left, and retained."""
    return flagged.agg(F.count("*").alias("total"), F.count_if(~F.col("properties_ok")).alias("removed_by_property"), F.count_if(F.col("properties_ok") & ~F.col("tokens_ok")).alias("removed_by_token"), F.count_if("success").alias("retained"))


def pass_counts(df: DataFrame, limits: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """One row for each property: rows inside its limits and their share, all in one pass."""
    each = [F.struct(F.lit(n).alias("property"), F.count_if(within(F.col(n), *b)).alias("passed"), F.count_if(~within(F.col(n), *b)).alias("removed")) for n, b in limits.items()]
    return df.agg(F.array(*each).alias("all")).select(F.explode("all").alias("s")).select("s.*", F.round(F.col("s.passed") / (F.col("s.passed") + F.col("s.removed")), 6).alias("pass_rate"))


def histogram(df: DataFrame, column: str, bins: int = 50, clip: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """bin, low, high, n between two quantiles."""
    c = no_nan(F.col(column))
    low, high = df.agg(F.percentile(c, list(clip))).first()[0] or (0.0, 0.0)
    if high <= low:
        high = low + 1.0
    step = (high - low) / bins
    inside = df.where((c >= low) & (c <= high)).select(F.least(F.floor((c - low) / step), F.lit(bins - 1)).cast("int").alias("bin"))
    return inside.groupBy("bin").agg(F.count("*").alias("n")).select("bin", (F.col("bin") * step + low).alias("low"), ((F.col("bin") + 1) * step + low).alias("high"), "n")


def with_components(df: DataFrame, properties: list[str]) -> tuple[DataFrame, list[float]]:
    """Add distribution_pca_x and _y of standardised complete rows (null for others), and the variance each explains.

    Means, deviations and the matrix of correlations are one aggregate each; the axes are theirs, so no row is moved. An axis
    points where its largest loading is positive.
    """
    import numpy as np

    if len(properties) < 2:
        raise ValueError("needs two properties at least")
    clean = [no_nan(F.col(p)) for p in properties]
    whole = clean[0].isNotNull()
    for c in clean[1:]:
        whole = whole & c.isNotNull()
    row = df.where(whole).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(clean)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(clean)], *[F.covar_pop(a, b).alias(f"c{i}_{j}") for i, a in enumerate(clean) for j, b in enumerate(clean) if i <= j]).first()
    n = len(clean)
    if row["m0"] is None:
        none = F.lit(None).cast("double")
        return df.withColumns({"distribution_pca_x": none, "distribution_pca_y": none}), [0.0, 0.0]
    spread = [row[f"s{i}"] or 1.0 for i in range(n)]
    matrix = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] / spread[i] / spread[j] for j in range(n)] for i in range(n)])
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:2]
    columns = {}
    for name, k in zip(("distribution_pca_x", "distribution_pca_y"), order):
        axis = axes[:, k] * np.sign(axes[np.abs(axes[:, k]).argmax(), k])
        point = sum(((c - F.lit(row[f"m{i}"])) * F.lit(float(axis[i] / spread[i])) for i, c in enumerate(clean)), F.lit(0.0))
        columns[name] = F.when(whole, point)
    return df.withColumns(columns), [float(v) for v in values[order] / max(values.sum(), 1e-12)]
