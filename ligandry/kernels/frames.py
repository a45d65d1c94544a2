"""Kernels on frames: one parse a row and stage, in Arrow batches; a row never fails the task."""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from importlib.util import find_spec
from types import ModuleType

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lite import KernelUnavailable

KERNELS = {"lite": "ligandry.kernels.lite", "rdkit": "ligandry.kernels.toolkit"}


def register_kernel(name: str, module: str) -> None:
    KERNELS[name] = module


def kernel(name: str | None = None) -> ModuleType:
    """The kernel of that name, or the toolkit's where it is installed, else lite."""
    name = name or ("rdkit" if find_spec("rdkit") else "lite")
    if name not in KERNELS:
        raise KernelUnavailable(f"unknown kernel {name!r}; known: {', '.join(KERNELS)}")
    if name == "rdkit" and not find_spec("rdkit"):
        raise KernelUnavailable("RDKit is not installed")
    return importlib.import_module(KERNELS[name])


def _mapped(df: DataFrame, column: str, schema: str, f) -> DataFrame:
    """df with a struct column _k of f(value), a tuple for each row."""
    names = [part.strip().rsplit(" ", 1)[0].strip("`") if "<" not in part else part.strip().split(" ")[0] for part in schema.split(", ")]

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([f(x) for x in s], columns=names, dtype=object)

    return df.withColumn("_k", run(F.col(column)))


def with_properties(df: DataFrame, smiles: str = "curated_smiles", names: list[str] | None = None, using: str | None = None) -> DataFrame:
    """Add the properties that are missing; columns that exist win; null for a string that can't be read."""
    k = kernel(using)
    wanted = names or list(k.KINDS)
    if unknown := [n for n in wanted if n not in k.KINDS]:
        raise KernelUnavailable(f"needs a chemistry toolkit: {', '.join(unknown)}")
    new = tuple(n for n in wanted if n not in df.columns)
    if not new:
        return df
    found = _mapped(df, smiles, ", ".join(f"{n} {k.KINDS[n]}" for n in new), lambda x: tuple((k.properties(x, new) or dict.fromkeys(new)).values()))
    return found.select(*df.columns, *[F.col(f"_k.{n}").alias(n) for n in new])


def with_descriptors(df: DataFrame, names: list[str], smiles: str = "curated_smiles", drop_invalid: bool = False, using: str | None = None) -> DataFrame:
    """Add any descriptors by name; with drop_invalid, rows that lack one go."""
    k = kernel(using)
    if not hasattr(k, "Descriptors"):
        k.descriptors(None, names)
    found = _mapped(df, smiles, ", ".join(f"`{n}` double" for n in names), lambda x: tuple((k.descriptors(x, names) or dict.fromkeys(names)).values()))
    out = found.select(*df.columns, *[F.col(f"_k.`{n}`").alias(n) for n in names])
    return out.na.drop(subset=names) if drop_invalid else out


def descriptor_summary(df: DataFrame, names: list[str]) -> DataFrame:
    """One row for each descriptor: mean, std, min, max and how many rows have it."""
    each = [F.struct(F.lit(n).alias("descriptor"), F.avg(n).alias("mean"), F.stddev_samp(n).alias("std"), F.min(n).cast("double").alias("min"), F.max(n).cast("double").alias("max"), F.count(n).alias("n_valid")) for n in names]
    return df.agg(F.array(*each).alias("all")).select(F.explode("all").alias("s")).select("s.*")


def curated(df: DataFrame, smiles: str = "canonical_smiles", dropna: bool = True, using: str | None = None, **how) -> DataFrame:
    """Add curated_smiles, curation_success, curation_step; a molecule with several isomers becomes several rows."""
    k = kernel(using)

    def one(x):
        text, good, step = k.curate(x, **how)
        return (text if isinstance(text, list) else [text]) if good else None, good, step

    found = _mapped(df, smiles, "isomers array<string>, curation_success boolean, curation_step string", one)
    rows = found.select(*df.columns, F.explode_outer("_k.isomers").alias("curated_smiles"), "_k.curation_success", "_k.curation_step")
    return rows.where("curation_success") if dropna else rows


def with_scaffolds(df: DataFrame, smiles: str = "curated_smiles", include_generic: bool = True, include_chirality: bool = False, acyclic_policy: str = "keep", dropna: bool = False, using: str | None = None) -> DataFrame:
    """Add scaffold_smiles ('' without rings, null where it fails), generic_scaffold_smiles and scaffold_success."""
    k = kernel(using)
    found = _mapped(df, smiles, "scaffold_smiles string, generic_scaffold_smiles string, scaffold_success boolean", lambda x: k.scaffold(x, include_generic, include_chirality))
    out = found.select(*df.columns, "_k.scaffold_smiles", *(["_k.generic_scaffold_smiles"] if include_generic else []), "_k.scaffold_success")
    out = out.where("scaffold_success") if dropna else out
    return out.where(~F.col("scaffold_smiles").eqNullSafe("")) if acyclic_policy == "remove" else out


def with_fingerprints(df: DataFrame, smiles: str = "curated_smiles", radius: int = 2, n_bits: int = 2048, using: str | None = None) -> DataFrame:
    """Add bits, a circular fingerprint in 64-bit words; null where it fails."""
    k = kernel(using)
    found = _mapped(df, smiles, "bits array<bigint>", lambda x: (k.fingerprint(x, radius, n_bits),))
    return found.select(*df.columns, F.col("_k.bits").alias("bits"))


REPORT = "Molecule string, Title string, Rotors int, n_conformers int, `ElapsedTime(s)` double, Status string, conformer_success boolean, mol binary"


def titled(df: DataFrame, names: str, order: list[str], backend: str = "rdkit") -> DataFrame:
    """Add Title: the names if there is one for each row, else numbered ones, counted over sorted slices."""
    if "Title" in df.columns:
        raise ValueError("a column named Title would clash with the conformer report")
    if names in df.columns and df.agg(F.count("*") == F.count_distinct(names)).first()[0]:
        return df.withColumn("Title", F.col(names).cast("string"))
    slices = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(64)))
    before = slices.groupBy("_slice").count().select("_slice", (F.sum("count").over(Window.orderBy("_slice")) - F.col("count")).alias("_before"))  # 64 rows
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(*order)) - 1
    return slices.withColumn("_place", place).join(F.broadcast(before), "_slice").withColumn("Title", F.concat(F.lit(f"{backend.upper()}_"), (F.col("_before") + F.col("_place")).cast("string"))).drop("_slice", "_place", "_before")


def with_conformers(df: DataFrame, smiles: str = "curated_smiles", names: str = "molecule_chembl_id", dropna: bool = True, using: str | None = None, **how) -> DataFrame:
    """Add the report's columns and mol, one task's molecules at a time; a column of df with such a name keeps it, the report's gets a suffix."""
    k = kernel(using)
    if k.__name__.endswith("lite"):
        k.conformers()
    held = titled(df, names, [smiles, *(c for c in df.columns if c != smiles)])
    found = _mapped(held, smiles, REPORT, lambda x: k.conformers(x, None, **how))
    parts = ["Rotors", "n_conformers", "ElapsedTime(s)", "Status", "conformer_success", "mol"]
    out = found.select(*held.columns, *[F.coalesce(F.col(f"_k.`{c}`"), F.lit(0)).cast("int").alias(_free(c, held)) if c == "n_conformers" else F.col(f"_k.`{c}`").alias(_free(c, held)) for c in parts])
    return out.where(F.col(_free("conformer_success", held))) if dropna else out


def _free(name: str, df: DataFrame, suffix: str = " (RDKIT)") -> str:
    return name if name.lower() not in {c.lower() for c in df.columns} else name + suffix


def conformer_totals(df: DataFrame) -> DataFrame:
    """One row: molecules, successes, conformers, their average, and failures by status as JSON."""
    failed = df.where(~F.col("conformer_success")).groupBy("Status").count().agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("Status", "count"))))).alias("failures"))  # a row for each status
    total = df.agg(F.count("*").alias("total"), F.count_if("conformer_success").alias("success"), F.coalesce(F.sum("n_conformers"), F.lit(0)).alias("conformers"), F.avg(F.when(F.col("conformer_success"), F.col("n_conformers"))).alias("average"))
    return total.join(F.broadcast(failed))  # one row each


def write_conformers(df: DataFrame, path: str, per_file: int = 50_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(path)


def read_conformers(spark, path: str) -> Iterator:
    """Rows of written conformers, one partition at a time."""
    return spark.read.parquet(path).toLocalIterator(prefetchPartitions=True)
