"""Activity curation: filters, standard labels, suspicious repeats and one representative row for each structure."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import mentions, minus_log10, no_nan
from ..registry import BAO_FORMATS, conversion, label_column, measurement


@dataclass(frozen=True)
class AssayParams:
    standard_type: str = "IC50"
    standard_units: str | None = None
    standard_relation: str | None = "="
    assay_type: str = "B"
    target_organism: str = "Homo sapiens"
    bao_format: str = "BAO_0000357"
    top_n: int = 5
    mutant_regex: str = "mutant|mutation|variant"
    allosteric_regex: str = "allosteric"
    mistakes_only: bool = True
    error_margin: float = 1e-4
    std_threshold: float = 0.5
    range_threshold: float = 0.5
    smiles_column: str = "canonical_smiles"
    legacy_units: bool = False

    def units(self) -> str | None:
        return self.standard_units or measurement(self.standard_type).units


def validity(p: AssayParams) -> list[Column]:
    """What every usable measurement fulfils, whatever its assay."""
    rules = [F.col("standard_flag").cast("int") == 1, F.col("potential_duplicate").cast("int") == 0, no_nan(F.col("standard_value").try_cast("double")).isNotNull(), F.col(p.smiles_column).isNotNull(), F.col("document_year").isNotNull(), F.col("document_chembl_id").isNotNull(), F.col("data_validity_comment").isNull()]
    return rules + ([F.col("pchembl_value").isNotNull()] if measurement(p.standard_type).potency else [])


def assay_filter(df: DataFrame, p: AssayParams) -> DataFrame:
    """All rules in one filter: equalities and null tests reach the scan, the two searches don't."""
    rules = [F.col("standard_type") == p.standard_type, F.col("assay_type") == p.assay_type, F.col("target_organism") == p.target_organism, F.col("bao_format") == p.bao_format, *validity(p)]
    if p.units():
        rules.append(F.col("standard_units") == p.units())
    if p.standard_relation:
        rules.append(F.col("standard_relation") == p.standard_relation)
    rules += [~mentions(F.col("assay_description"), p.mutant_regex), ~mentions(F.col("assay_description"), p.allosteric_regex)]
    return df.filter(reduce(lambda a, b: a & b, rules))


def standardise(df: DataFrame, p: AssayParams) -> DataFrame:
    label = label_column(p.standard_type)
    value = F.col("standard_value").try_cast("double")
    return df.withColumn(label, minus_log10(value, conversion(p.units(), p.legacy_units)) if measurement(p.standard_type).potency else no_nan(value))


def suspicious_keys(df: DataFrame, key: str, value: str, margin: float = 1e-4, gaps=(3.0,)) -> DataFrame:
    """Keys with two values whose difference is one of gaps, give or take margin.

    Values are sorted within salted range slices of a key by the shuffle; a value only meets those in its own or the next
    slice of width gap, so the pairs of a large key stay with the values that can match.
    """
    v = df.where(F.col(key).isNotNull()).select(F.col(key), F.col(value).alias("v")).where("v IS NOT NULL").distinct()
    found = None
    for gap in gaps:
        width = 2 * margin
        low = v.select(key, F.col("v").alias("low"), F.floor((F.col("v") + gap) / width).alias("slot"))
        low = low.select(key, "low", F.explode(F.array(F.col("slot") - 1, F.col("slot"), F.col("slot") + 1)).alias("slot"))
        high = v.select(key, F.col("v").alias("high"), F.floor(F.col("v") / width).alias("slot"))
        near = low.join(high, [key, "slot"]).where(F.abs(F.col("high") - F.col("low") - gap) < margin).select(key).distinct()
        found = near if found is None else found.union(near)
    return found.distinct()


def repeated_keys(df: DataFrame, key: str, value: str, margin: float = 1e-4) -> DataFrame:
    """Keys with two rows whose values are equal or at most margin apart."""
    v = df.where(F.col(key).isNotNull()).select(F.col(key), F.col(value).alias("v")).where("v IS NOT NULL").groupBy(key, "v").agg(F.count("*").alias("n"))
    found = v.where("n > 1").select(key)
    if margin > 0:
        low = v.select(key, F.col("v").alias("low"), F.floor(F.col("v") / (2 * margin)).alias("slot"))
        high = v.select(key, F.col("v").alias("high"), F.floor(F.col("v") / (2 * margin)).alias("slot"))
        low = low.select(key, "low", F.explode(F.array(F.col("slot"), F.col("slot") + 1)).alias("slot"))
        near = low.join(high, [key, "slot"]).where((F.col("high") > F.col("low")) & (F.col("high") - F.col("low") <= margin))
        found = found.union(near.select(key))
    return found.distinct()


def drop_suspicious(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys, key, "left_anti")


def duplicate_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """mean, min, max, std (0 for a single row) and count of value for each key."""
    return df.groupBy(key).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"), F.count(value).alias("count"))


def consistent(stats: DataFrame, std: float, spread: float) -> DataFrame:
    return stats.filter((F.col("std") < std) & (F.abs(F.col("max") - F.col("min")) < spread))


def earliest_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in that order. Each task passes on only its own first rows before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def representatives(df: DataFrame, key: str, value: str, order: list[str], std: float, spread: float) -> DataFrame:
    """The earliest row of each consistent key, its value replaced by the mean, with min, max, std and count.

    Statistics come from a hash aggregate over two columns; whole rows are moved only if they are first in their task. Null
    values are no evidence: a key without any value goes.
    """
    stats = consistent(duplicate_stats(df, key, value).withColumnRenamed("mean", value), std, spread)
    rest = [c for c in df.columns if c not in (key, value, "min", "max", "std", "count")]
    return earliest_rows(df.where(F.col(key).isNotNull()), key, order).select(key, *rest).join(stats, key).select(key, *rest, value, "min", "max", "std", "count")


def conflicting_ids(df: DataFrame, key: str, identity: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(identity).alias("n_ids")).where("n_ids > 1")


def condition_frequency(df: DataFrame, fields: list[str], top_n: int) -> DataFrame:
    """The most frequent combinations, nulls included, with their share of all rows."""
    counted = df.groupBy(*fields).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    shared = counted.crossJoin(F.broadcast(total)).withColumn("percent", F.round(100.0 * F.col("n") / F.col("total"), 4)).drop("total")  # one row
    return shared.orderBy(F.desc("n"), *[F.asc_nulls_last(f) for f in fields]).limit(top_n)


def condition_report(df: DataFrame, p: AssayParams, fields: tuple[str, ...] = ("standard_type", "assay_type", "target_organism", "bao_format")) -> DataFrame:
    """The most frequent conditions among all rows (RAW) and among usable ones (VALID), with the format's label."""
    found = None
    for name, rows in (("RAW", df), ("VALID", df.filter(reduce(lambda a, b: a & b, validity(p))))):
        part = condition_frequency(rows, list(fields), p.top_n).withColumn("subset", F.lit(name))
        found = part if found is None else found.unionByName(part)
    return found.withColumn("format", bao_label(F.col("bao_format"))) if "bao_format" in fields else found


def recommended(report: DataFrame, p: AssayParams) -> dict[str, tuple[object, object]]:
    """Fields in which the parameters differ from the most frequent usable condition, as (configured, found); empty if best."""
    best = report.where("subset = 'VALID'").orderBy(F.desc("n")).first()
    if best is None:
        return {}
    return {f: (getattr(p, f), best[f]) for f in ("standard_type", "assay_type", "target_organism", "bao_format") if f in best and best[f] != getattr(p, f)}


def summary(stats: DataFrame, std: float, spread: float) -> DataFrame:
    """One row: groups, singles, aggregated and removed groups of duplicate_stats()."""
    ok = (F.col("std") < std) & (F.abs(F.col("max") - F.col("min")) < spread)
    return stats.agg(F.count("*").alias("groups"), F.count_if(F.col("count") == 1).alias("singles"), F.count_if((F.col("count") > 1) & ok).alias("aggregated"), F.count_if(~ok).alias("removed"))


def bao_label(c: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in BAO_FORMATS.items() for x in kv]), c), F.lit("unmapped"))


def dedup(df: DataFrame, key: list[str], order: list[Column], keep: str | bool = "first") -> DataFrame:
    """One row for each key, first or last in that order, or with keep=False only rows whose key is unique."""
    by = Window.partitionBy(*key)
    if keep is False:
        return df.withColumn("_n", F.count("*").over(by)).where("_n = 1").drop("_n")
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first, last or False, not {keep!r}")
    ranked = [c if keep == "first" else c.desc() for c in order]
    return df.withColumn("_n", F.row_number().over(by.orderBy(*ranked))).where("_n = 1").drop("_n")


def curate(df: DataFrame, p: AssayParams) -> DataFrame:
    """Filter, label, drop suspicious structures, one representative for each of the rest."""
    label, key = label_column(p.standard_type), p.smiles_column
    done = standardise(assay_filter(df, p), p)
    gaps = (1.0, 3.0) if p.standard_type in ("Ki", "Kd") else (3.0,)
    if measurement(p.standard_type).potency:
        keys = suspicious_keys(done, key, label, p.error_margin, gaps)
        if not p.mistakes_only:
            keys = keys.union(repeated_keys(done, key, label, p.error_margin)).distinct()
        done = drop_suspicious(done, keys, key)
    order = ["document_year", *sorted(c for c in df.columns if c not in (key, "document_year"))]
    return representatives(done, key, label, order, p.std_threshold, p.range_threshold)
