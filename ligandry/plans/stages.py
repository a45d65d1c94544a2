"""The stages beyond assays, tokens and distributions: source, curation, properties, scaffolds, splits and conformers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..kernels import frames
from ..operators import assays, split
from ..sources import rest, sqlite, tables
from . import report


@dataclass(frozen=True)
class SourceParams:
    backend: str = "sql"
    n: int = 1000
    search_all: bool = True
    db_path: str | None = None
    url: str | None = None

    def __post_init__(self):
        if self.n <= 0:
            raise ValueError("n must be positive")
        if self.backend not in BACKENDS:
            raise ValueError(f"unknown backend {self.backend!r}; known: {', '.join(BACKENDS)}")


def _from_sql(spark, p: SourceParams, target: str) -> DataFrame:
    if not p.db_path:
        raise ValueError("source.db_path is needed: an SQLite file, or a folder with a Parquet table for each name")
    names = ("activities", "assays", "target_dictionary", "molecule_dictionary", "compound_structures", "docs")
    read = (lambda t: sqlite.read_table(spark, p.db_path, t)) if p.db_path.endswith((".db", ".sqlite")) else lambda t: spark.read.parquet(f"{p.db_path}/{t}.parquet")
    return tables.fetch({t: read(t) for t in names}, target, None if p.search_all else p.n)


def _from_api(spark, p: SourceParams, target: str) -> DataFrame:
    if not p.url:
        raise ValueError("source.url is needed")
    return rest.read_pages(spark, p.url, "activities", list(tables.REST_COLUMNS), None if p.search_all else p.n, query=f"target_chembl_id={target}")


#: How a target's activities are read; register_backend() adds others.
BACKENDS = {"sql": _from_sql, "api": _from_api}


def register_backend(name: str, read) -> None:
    BACKENDS[name] = read


@dataclass(frozen=True)
class CurateParams:
    smiles_column: str = "canonical_smiles"
    kernel: str | None = None
    mol_steps: tuple[str, ...] | None = None
    desalt_policy: str = "keep"
    neutralize_policy: str = "keep"
    stereo_policy: str = "assign"
    assign_policy: str = "random"
    brute_force_desalt: bool = False
    max_tautomers: int = 512
    step_timeout: int = 60
    random_seed: int = 42
    try_embedding: bool = False
    only_unassigned: bool = True
    only_unique: bool = True
    max_isomers: int = 32
    dropna: bool = True
    check_duplicates: bool = True
    duplicates_policy: str | bool = "first"

    def __post_init__(self):
        steps = self.mol_steps or ()
        if len(set(steps)) != len(steps):
            raise ValueError("a curation step is given twice")
        if self.stereo_policy == "enumerate" and steps and steps[-1] != "handleStereo":
            raise ValueError("enumerated isomers must come from the last step")
        if self.duplicates_policy not in ("first", "last", False):
            raise ValueError("duplicates_policy is first, last or False")


def curate(df: DataFrame, p: CurateParams, ctx) -> DataFrame:
    """Curated molecules; where some become equal, their activities are averaged again if there is a label, else one row stays."""
    k = frames.kernel(p.kernel)
    how = {"steps": tuple(p.mol_steps or k.STEPS), "desalt": p.desalt_policy, "neutralize": p.neutralize_policy, "stereo": p.stereo_policy}
    if k.__name__.endswith("lite"):
        how["stereo"] = "remove"
    else:
        how |= {n: getattr(p, n) for n in ("assign_policy", "brute_force_desalt", "max_tautomers", "step_timeout", "random_seed", "try_embedding", "only_unassigned", "only_unique", "max_isomers")}
    out = frames.curated(df, p.smiles_column, p.dropna, p.kernel, **how)
    if not p.check_duplicates:
        return out
    order = [c for c in out.columns if not out.schema[c].dataType.typeName() in ("map", "binary")]
    label = ctx.results.get("assays", {}).get("output_label")
    if label in out.columns:
        held = out.drop("min", "max", "std", "count")
        assay = ctx.values.get("assay_params") or assays.AssayParams()
        return assays.representatives(held, "curated_smiles", label, [c for c in ("document_year", *held.columns) if c in held.columns and c != "curated_smiles"], assay.std_threshold, assay.range_threshold)
    return assays.dedup(out, ["curated_smiles"], [F.col(c) for c in order], p.duplicates_policy)


@dataclass(frozen=True)
class PropertyParams:
    properties: tuple[str, ...] | None = None
    smiles_column: str = "curated_smiles"
    filter_invalid: bool = False
    kernel: str | None = None


def properties(df: DataFrame, p: PropertyParams, ctx) -> DataFrame:
    names = list(p.properties or frames.kernel(p.kernel).KINDS)
    out = frames.with_properties(df, p.smiles_column, names, p.kernel)
    return out.na.drop(subset=names) if p.filter_invalid else out


@dataclass(frozen=True)
class ScaffoldParams:
    smiles_column: str = "curated_smiles"
    include_generic: bool = True
    include_chirality: bool = False
    dropna: bool = False
    acyclic_policy: str = "keep"
    kernel: str | None = None

    def __post_init__(self):
        if self.acyclic_policy not in ("keep", "remove"):
            raise ValueError("acyclic_policy is keep or remove")


def scaffold(df: DataFrame, p: ScaffoldParams, ctx) -> DataFrame:
    out = frames.with_scaffolds(df, p.smiles_column, p.include_generic, p.include_chirality, p.acyclic_policy, p.dropna, p.kernel)
    n = out.agg(F.count("*").alias("n_total"), F.count_if("scaffold_success").alias("n_scaffolds"), F.count_distinct(F.when(F.col("scaffold_smiles") != "", F.col("scaffold_smiles"))).alias("n_unique_scaffolds")).first()
    ctx.results["scaffold"] = n.asDict()
    return out


@dataclass(frozen=True)
class SplitParams:
    unit: str = "scaffold"
    method: str = "isolation"
    train_label: str = "train"
    val_label: str = "val"
    test_label: str = "test"
    test_ratio: float = 0.1
    val_ratio: float = 0.1
    max_units_for_isolation: int = 10_000
    low_n_threshold: int = 5_000
    seed: int = 42
    activity_column: str | None = None
    ecfp4_radius: int = 2
    ecfp4_n_bits: int = 2048
    max_nn_dist_n: int = 10_000
    smiles_column: str = "curated_smiles"
    kernel: str | None = None

    def __post_init__(self):
        if len({self.train_label, self.val_label, self.test_label}) < 3:
            raise ValueError("labels must differ")
        if self.unit not in ("scaffold", "molecule") or self.method not in ("isolation", "random"):
            raise ValueError("unit is scaffold or molecule, method isolation or random")
        if not (0 < self.test_ratio < 1 and 0 < self.val_ratio < 1 and self.test_ratio + self.val_ratio < 1):
            raise ValueError("ratios must lie between 0 and 1 and sum to less than 1")


def split_rows(df: DataFrame, p: SplitParams, ctx) -> DataFrame:
    """Add split. Units move as a whole; rows without a unit, and units that can't be compared, go to train."""
    key = "scaffold_smiles" if p.unit == "scaffold" else p.smiles_column
    tables.require_columns(df, [key], "split")
    units = split.units(df, key, F.col(key))  # numbered in the order of their names, which rows arriving otherwise don't change
    total = df.count()
    if p.method == "isolation":
        n = units.count()
        if n > p.max_units_for_isolation:
            raise ValueError(f"{n} units; isolation takes {p.max_units_for_isolation} at most, use method random")
        bits = frames.with_fingerprints(units, "unit", p.ecfp4_radius, p.ecfp4_n_bits, p.kernel).withColumnRenamed("pos", "id")
        scores = split.isolation(bits, p.max_units_for_isolation).join(bits.select("id", "unit", "size"), "id")
        filled = split.greedy_fill(split.isolation_ranks(scores, "id"), F.col("rank"), total, p.test_ratio, p.val_ratio)
    else:
        ranked = units.join(split.random_ranks(units, units.count(), p.seed), "pos")
        filled = split.greedy_fill(ranked, F.col("rank"), total, p.test_ratio, p.val_ratio)
    names = F.create_map(*[F.lit(x) for x in ("train", p.train_label, "val", p.val_label, "test", p.test_label)])
    labels = filled.select(F.col("unit").alias(key), F.col("split"))
    out = df.join(labels, key, "left").withColumn("split", F.coalesce("split", F.lit("train")))
    activity = p.activity_column or ctx.results.get("assays", {}).get("output_label")
    rows_bits = None
    if total <= p.max_nn_dist_n:
        rows_bits = frames.with_fingerprints(out.select(p.smiles_column, "split"), p.smiles_column, p.ecfp4_radius, p.ecfp4_n_bits, p.kernel).withColumn("id", F.monotonically_increasing_id())
    ctx.results["split"] = report.split_report(out, "scaffold_smiles", activity, rows_bits, "molecule" if p.unit == "molecule" else p.method, p.max_nn_dist_n)
    if total < p.low_n_threshold:
        ctx.results["split"]["warnings"].append(f"only {total} rows: measures of the splits are noisy")
    return out.withColumn("split", names[F.col("split")])


@dataclass(frozen=True)
class ConformerParams:
    backend: str = "rdkit"
    smiles_column: str = "curated_smiles"
    names_column: str = "molecule_chembl_id"
    max_confs: int = 200
    rms_threshold: float = 0.5
    dropna: bool = True
    use_random_coords: bool = True
    random_seed: int = 42
    use_uff: bool = True
    max_iterations: int = 200


def conformers(df: DataFrame, p: ConformerParams, ctx) -> DataFrame:
    """Many small partitions: cost differs a lot between molecules."""
    spread = df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
    how = {n: getattr(p, n) for n in ("max_confs", "rms_threshold", "use_random_coords", "random_seed", "use_uff", "max_iterations")}
    return frames.with_conformers(spread, p.smiles_column, p.names_column, p.dropna, p.backend, **how)


def molecule_provider(steps: tuple[str, ...]) -> str | None:
    """The step whose molecules later ones take: conformers if there are any, else curated ones."""
    return next((s for s in ("confs", "curate") if s in steps), None)
