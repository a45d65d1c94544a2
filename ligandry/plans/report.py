"""Reports of a run: configuration, curation results, split report, plot data, logs. Driver-side; each from rows of bounded number."""

from __future__ import annotations

import json
import logging
import os
import platform
from collections.abc import Iterable
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import distributions, split
from ..operators.distributions import Threshold


def duration(seconds: float) -> str:
    """3.2s, 4m 5.0s or 1h 2m 3.0s."""
    hours, rest = divmod(seconds, 3600)
    minutes, rest = divmod(rest, 60)
    return (f"{int(hours)}h " if hours else "") + (f"{int(minutes)}m " if hours or minutes else "") + f"{rest:.1f}s"


def threshold_text(t: Threshold, limits: tuple[float | None, float | None]) -> str:
    """How a property's bounds came about, such as '≥μ-2.0σ (0.23), ≤30'."""
    sides = []
    for sign, absolute, sigmas, quantile, value in (("≥", t.min_value, t.statistical_lower, t.quantile_lower, limits[0]), ("≤", t.max_value, t.statistical_upper, t.quantile_upper, limits[1])):
        shown = "none" if value is None else f"{value:.2f}"
        if absolute is not None:
            sides.append(f"{sign}{absolute:g}")
        elif sigmas is not None:
            sides.append(f"{sign}μ{sigmas:+.1f}σ ({shown})")
        elif quantile is not None:
            sides.append(f"{sign}q{quantile:g} ({shown})")
    return ", ".join(sides) or "no limit"


def write_json(path: str | Path, value: Any) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=1, ensure_ascii=False, default=str), encoding="utf-8")


def run_config(config, input_id: str, kind: str) -> dict:
    """The canonical configuration and what the run was."""
    return config.to_dict() | {"run": {"run_id": f"{input_id}_ID{config.hash()}", "input_id": input_id, "input_kind": kind, "started": datetime.now(UTC).isoformat(timespec="seconds"), "python": platform.python_version()}}


def curation_results(flagged: DataFrame, thresholds: dict[str, Threshold], limits: dict, unknown: Iterable[str] = (), rare: Iterable[str] = ()) -> dict:
    """Bounds, statistics, normality, pass counts and funnel of flagged rows (see distributions.curate with drop=False)."""
    statistics = {r.property: r.asDict() for r in distributions.statistics(flagged, limits).collect()} if limits else {}
    for name, s in statistics.items():
        s["normality"] = distributions.normality(s["count"], s["skew"], s["kurtosis"])
        s["threshold"] = threshold_text(thresholds.get(name, Threshold()), limits[name])
        s["low"], s["high"] = limits[name]
    passed = [r.asDict() for r in distributions.pass_counts(flagged, limits).collect()] if limits else []
    return {"properties": statistics, "passed": passed, "funnel": distributions.funnel(flagged).first().asDict(), "unknown_tokens": sorted(unknown), "rare_tokens": sorted(rare)}


def plot_data(df: DataFrame, column: str, bins: int = 50, points: int = 99) -> dict:
    """Histogram, normal curve and quantile-quantile points of a column."""
    bars = [r.asDict() for r in distributions.histogram(df, column, bins).orderBy("bin").collect()]
    qs = [(i + 1) / (points + 1) for i in range(points)]
    row = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.percentile(column, qs).alias("q")).first()
    from statistics import NormalDist

    normal = [NormalDist().inv_cdf(q) for q in qs]
    return {"histogram": bars, "mean": row["mean"], "std": row["std"], "qq": list(zip(normal, row["q"] or []))}


def split_report(df: DataFrame, scaffold: str | None = "scaffold_smiles", activity: str | None = None, units_bits: DataFrame | None = None, method: str = "isolation", max_units: int = split.MAX_UNITS) -> dict:
    """Composition, scaffolds, overlaps, nearest distances, fingerprint counts and activity by split, with warnings."""
    report: dict[str, Any] = {"method": method, "composition": {r.split: r.asDict() for r in split.composition(df).collect()}, "warnings": []}
    if scaffold and scaffold in df.columns:
        held = df.where(F.coalesce(F.col(scaffold), F.lit("")) != "")
        report["scaffolds"] = {r.split: r.asDict() for r in split.scaffold_stats(held, scaffold).collect()}
        report["overlap"] = split.scaffold_overlap(held, scaffold).first().asDict()
        report["without_scaffold"] = df.count() - held.count()
        if method != "molecule" and any(report["overlap"].values()):
            report["warnings"].append("scaffolds appear in more than one split")
    if units_bits is not None:
        report["fingerprints"] = {r.split: r.asDict() for r in split.fingerprint_qc(units_bits).collect()}
        if units_bits.count() <= max_units:
            report["nearest"] = [r.asDict() for r in split.nearest_summary(units_bits, max_units).collect()]
        else:
            report["warnings"].append(f"nearest distances left out: more than {max_units} rows")
    if activity and activity in df.columns:
        report["activity"] = {r.split: r.asDict() for r in split.activity_summary(df, activity).collect()}
        ks = split.ks_statistic(df, activity).first()
        p = split.ks_p_value(ks.statistic, ks.n_a, ks.n_b) if ks.statistic is not None else None
        report["ks"] = {"statistic": ks.statistic, "p_value": p}
    return report


def logger(name: str, path: str | None = None, console: str = "INFO", file: str = "DEBUG") -> logging.Logger:
    """A logger to the console and, with path, to a file of the run; its handlers replace those of the run before."""
    out = logging.getLogger(f"ligandry.{name}")
    out.setLevel(logging.DEBUG)
    out.propagate = False
    for old in list(out.handlers):
        out.removeHandler(old)
        old.close()
    handlers: list[tuple[logging.Handler, str]] = [(logging.StreamHandler(), console)]
    if path:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        handlers.append((logging.FileHandler(path, encoding="utf-8"), file))
    for handler, level in handlers:
        handler.setLevel(level)
        handler.setFormatter(logging.Formatter("%(asctime)s | %(levelname)-7s | %(name)-24s | %(message)s"))
        out.addHandler(handler)
    return out
