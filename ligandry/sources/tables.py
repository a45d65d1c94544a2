"""Inputs: tables in Parquet or CSV, frames, and the fetch that joins activity tables for one target."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: list[str], who: str = "stage") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{who} needs columns that are missing: {', '.join(missing)}")


def resolve(spark: SparkSession, source, input_id: str | None = None) -> tuple[DataFrame | None, str, str]:
    """(frame, id, kind) of an input: a frame with an id, a .csv or .parquet path, or a target id."""
    if isinstance(source, DataFrame):
        if not input_id:
            raise ValueError("a frame needs an input_id")
        return source, input_id, "frame"
    if hasattr(source, "to_dict") and hasattr(source, "columns"):
        if not input_id:
            raise ValueError("a frame needs an input_id")
        return spark.createDataFrame(source), input_id, "frame"
    name = str(source)
    if name.upper().startswith("CHEMBL") and not name.lower().endswith((".csv", ".parquet")):
        return None, input_id or name, "target"
    stem = PurePosixPath(name).stem
    if name.lower().endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).option("multiLine", True).option("escape", '"').csv(name), input_id or stem, "csv"
    if name.lower().endswith(".parquet"):
        return spark.read.parquet(name), input_id or stem, "parquet"
    raise ValueError(f"not a target id, a .csv or .parquet path, or a frame: {name!r}")


# What the activity service calls its fields.
REST_COLUMNS = ("activity_id", "assay_chembl_id", "assay_description", "assay_type", "bao_format", "canonical_smiles", "data_validity_comment", "document_chembl_id", "document_year", "molecule_chembl_id", "pchembl_value", "potential_duplicate", "relation", "standard_flag", "standard_relation", "standard_type", "standard_units", "standard_value", "target_chembl_id", "target_organism", "target_pref_name")


def _renamed(df: DataFrame, **names: str) -> list:
    """Columns under new names, those that df has."""
    return [F.col(old).alias(new) for old, new in names.items() if old in df.columns]


def fetch(tables: dict[str, DataFrame], target: str, limit: int | None = None) -> DataFrame:
    """Activities of one target with assay, molecule, structure and document columns.

    The target filter shrinks its dimension to a row before the joins, so the activity scan is joined with the few assays
    of that target. A limit takes the smallest activity ids.
    """
    target_columns = [F.col("chembl_id").alias("target_chembl_id"), *_renamed(tables["target_dictionary"], pref_name="target_pref_name", target_type="target_type", organism="target_organism", tax_id="target_tax_id")]
    chosen = tables["target_dictionary"].where(F.col("chembl_id") == target).select("tid", *target_columns)
    assay_columns = _renamed(tables["assays"], assay_type="assay_type", description="assay_description", bao_format="bao_format", **{c: c for c in ("assay_organism", "assay_tax_id", "assay_strain", "assay_tissue", "assay_cell_type", "assay_subcellular_fraction")})
    assays = tables["assays"].join(F.broadcast(chosen), "tid").select("assay_id", *assay_columns, *[c for c in chosen.columns if c != "tid"])  # one target
    molecules = tables["molecule_dictionary"].select("molregno", *_renamed(tables["molecule_dictionary"], chembl_id="molecule_chembl_id", pref_name="molecule_pref_name"))
    structures = tables["compound_structures"].select("molregno", *_renamed(tables["compound_structures"], canonical_smiles="canonical_smiles", standard_inchi="standard_inchi", standard_inchi_key="standard_inchi_key"))
    documents = tables["docs"].select("doc_id", *_renamed(tables["docs"], chembl_id="document_chembl_id", year="document_year", **{c: c for c in ("journal", "volume", "issue", "first_page", "last_page", "pubmed_id", "doi")}))
    found = tables["activities"].join(assays, "assay_id").join(molecules, "molregno", "left").join(structures, "molregno", "left").join(documents, "doc_id", "left")
    return found.orderBy("activity_id").limit(limit) if limit else found


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV with arrays and structs as JSON; Parquet is the format to keep."""
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
    flat.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
