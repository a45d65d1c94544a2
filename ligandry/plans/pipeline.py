"""Pipelines: named stages with typed parameters, a stable configuration hash, and checkpoints in Parquet."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import time
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import token_atom_ratio, tokenize
from ..kernels import frames
from ..operators import assays, distributions
from ..operators.vocabulary import Vocabulary
from ..sources.tables import require_columns, resolve, write_csv
from . import report, stages

#: Settings of a run, with their defaults. They don't enter the configuration's hash.
RUN_DEFAULTS = {"output_root": "LIGANDRY_OUT", "write_output": True, "write_checkpoints": False, "return_none_on_fail": False, "override_actor_params": True, "console_log_level": "INFO", "file_log_level": "DEBUG", "run_id": None}
RUN_KEYS = tuple(RUN_DEFAULTS)


@dataclass
class RunContext:
    """Driver-side state that stages share; never part of what executors get."""

    input_id: str = "input"
    folder: str | None = None
    spark: Any = None
    results: dict[str, Any] = field(default_factory=dict)
    values: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[DataFrame, Any, RunContext], DataFrame]
    params: type
    requires: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    place: str | None = None  # "first" or "last": elsewhere it gets a warning


@dataclass(frozen=True)
class TokenParams:
    smiles_column: str = "canonical_smiles"
    vocab_file: str | None = None
    dynamically_update_vocab: bool = True


@dataclass(frozen=True)
class DistributionParams:
    thresholds: dict = field(default_factory=dict)
    global_statistical_threshold: float | None = None
    global_quantile_threshold: float | None = None
    properties: tuple[str, ...] | str | None = None
    compute_properties: bool = True
    perform_pca: bool = False
    smiles_column: str = "curated_smiles"
    kernel: str | None = None
    curate_tokens: bool = True
    filter_unknown_tokens: bool = True
    token_frequency_threshold: float | None = None
    dropna: bool = True

    def __post_init__(self):
        if self.token_frequency_threshold is not None and not 0 <= self.token_frequency_threshold <= 100:
            raise ValueError("token_frequency_threshold is a percentage")
        if self.global_statistical_threshold is not None and self.global_quantile_threshold is not None:
            raise ValueError("one global threshold at most")
        if self.global_quantile_threshold is not None and not 0 < self.global_quantile_threshold < 0.5:
            raise ValueError("global_quantile_threshold lies between 0 and 0.5")

    def named(self, present: list[str]) -> list[str]:
        """Properties to look at: those named, all for a global threshold without names, those with a threshold in any case."""
        names = self.properties if self.properties is not None else "all" if self.general() else ()
        names = [*frames.kernel(self.kernel).KINDS, "num_tokens", "tokens_atom_ratio"] if names == "all" else list(names)
        return list(dict.fromkeys([*names, *self.thresholds]))

    def general(self) -> distributions.Threshold | None:
        if self.global_statistical_threshold is not None:
            return distributions.Threshold(statistical_lower=-abs(self.global_statistical_threshold), statistical_upper=abs(self.global_statistical_threshold))
        if self.global_quantile_threshold is not None:
            return distributions.Threshold(quantile_lower=self.global_quantile_threshold, quantile_upper=1 - self.global_quantile_threshold)
        return None


def _assays(df: DataFrame, p: assays.AssayParams, ctx: RunContext) -> DataFrame:
    ctx.results["assays"] = {"output_label": assays.label_column(p.standard_type)}
    ctx.values["assay_params"] = p
    return assays.curate(df, p)


def _tokens(df: DataFrame, p: TokenParams, ctx: RunContext) -> DataFrame:
    out = df.withColumn("tokens", tokenize(F.col(p.smiles_column))).withColumn("seqlen", F.size("tokens"))
    vocabulary = Vocabulary.load(p.vocab_file) if p.vocab_file else ctx.values.get("vocabulary") or Vocabulary.from_frame(out)
    if p.dynamically_update_vocab and (p.vocab_file or "vocabulary" in ctx.values):
        vocabulary.update(sorted(Vocabulary.from_frame(out).ids))
    ctx.values["vocabulary"] = vocabulary
    return out


def _computed(df: DataFrame, p: DistributionParams) -> DataFrame:
    """Properties that are asked for and missing."""
    wanted = [n for n in p.named(df.columns) if n not in df.columns]
    kinds = frames.kernel(p.kernel).KINDS
    chemical = [n for n in wanted if n in kinds]
    if "tokens_atom_ratio" in wanted and "num_atoms" not in df.columns and "num_atoms" not in chemical:
        chemical.append("num_atoms")
    if chemical and p.smiles_column in df.columns:
        df = frames.with_properties(df, p.smiles_column, chemical, p.kernel)
    if "num_tokens" in wanted and "tokens" in df.columns:
        df = df.withColumn("num_tokens", F.col("seqlen") if "seqlen" in df.columns else F.size("tokens"))
    if "tokens_atom_ratio" in wanted and "tokens" in df.columns and "num_atoms" in df.columns:
        df = df.withColumn("tokens_atom_ratio", token_atom_ratio(F.size("tokens"), F.col("num_atoms")))
    return df


def _distributions(df: DataFrame, p: DistributionParams, ctx: RunContext) -> DataFrame:
    df = _computed(df, p) if p.compute_properties else df
    names = [n for n in p.named(df.columns) if n in df.columns]
    thresholds = {n: t if isinstance(t, distributions.Threshold) else distributions.Threshold(**t) for n, t in p.thresholds.items()}
    if missing := [n for n in thresholds if n not in df.columns]:
        raise ValueError(f"thresholds for columns that are missing: {', '.join(missing)}")
    if general := p.general():
        thresholds |= {n: general for n in names if n not in thresholds}
    limits = distributions.bounds(df, thresholds)
    vocabulary = ctx.values.get("vocabulary") if p.curate_tokens and p.filter_unknown_tokens else None
    rare = []
    if p.curate_tokens and p.token_frequency_threshold is not None:
        rare = [r.token for r in distributions.token_frequency(df).where(f"percent < {float(p.token_frequency_threshold)}").collect()]
    if p.perform_pca and len(names) > 1:
        df, ctx.results["explained_variance"] = distributions.with_components(df, names)
    flagged = distributions.curate(df, limits, vocabulary.tokens() if vocabulary else None, rare, drop=False)
    ctx.results["distributions"] = {"limits": limits, "rare_tokens": sorted(rare)}
    if ctx.folder:
        ctx.results["distributions"]["report"] = report.curation_results(flagged, thresholds, limits, (), rare)
        if vocabulary:
            kept = Vocabulary.from_frame(flagged.where("success"))
            report.write_json(f"{ctx.folder}/vocabulary_curated.json", {"tokens": kept.tokens(), "unused": sorted(set(vocabulary.ids) - set(kept.ids))})
    return flagged.where("success") if p.dropna else flagged


def _source(df: DataFrame | None, p: stages.SourceParams, ctx: RunContext) -> DataFrame:
    if df is not None:
        return df
    return stages.BACKENDS[p.backend](ctx.spark, p, ctx.input_id)


STAGES: dict[str, Stage] = {}


def register(stage: Stage) -> None:
    STAGES[stage.name] = stage


register(Stage("source", _source, stages.SourceParams, place="first"))
register(Stage("assays", _assays, assays.AssayParams, columns=("standard_value", "standard_units", "standard_type", "standard_relation", "standard_flag", "potential_duplicate", "pchembl_value", "data_validity_comment", "document_year", "document_chembl_id", "assay_type", "assay_description", "target_organism", "bao_format")))
register(Stage("curate", stages.curate, stages.CurateParams))
register(Stage("tokens", _tokens, TokenParams))
register(Stage("distributions", _distributions, DistributionParams))
register(Stage("confs", stages.conformers, stages.ConformerParams, requires=("curate",)))
register(Stage("properties", stages.properties, stages.PropertyParams))
register(Stage("scaffold", stages.scaffold, stages.ScaffoldParams, requires=("curate",)))
register(Stage("split", stages.split_rows, stages.SplitParams, requires=("scaffold",), place="last"))

#: Configurations to start from.
TEMPLATES = {
    "api": {"steps": ["source", "assays", "curate", "tokens"], "source": {"backend": "api"}},
    "basic": {"steps": ["source", "assays", "curate", "tokens"]},
    "distributions": {"steps": ["source", "assays", "curate", "tokens", "distributions"], "distributions": {"global_statistical_threshold": 2.0}},
    "conformers": {"steps": ["source", "assays", "curate", "tokens", "confs"]},
    "full": {"steps": ["source", "assays", "curate", "tokens", "distributions", "confs", "scaffold", "split"], "distributions": {"global_statistical_threshold": 2.0}},
}


def discover(folder: str) -> list[str]:
    """Register the stages of all Python files in a folder: each names STAGE, a Stage. Returns their names."""
    import importlib.util
    from pathlib import Path

    found = []
    for path in sorted(Path(folder).glob("*.py")):
        spec = importlib.util.spec_from_file_location(f"ligandry_plugin_{path.stem}", path)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        if isinstance(stage := getattr(module, "STAGE", None), Stage):
            register(stage)
            found.append(stage.name)
    return found


def describe(name: str) -> list[dict]:
    """Name, type and default of each parameter of a stage, and the values it takes where it says so."""
    out = []
    for f in dataclasses.fields(STAGES[name].params):
        default = f.default if f.default is not dataclasses.MISSING else f.default_factory() if f.default_factory is not dataclasses.MISSING else None
        out.append({"name": f.name, "type": f.type if isinstance(f.type, str) else f.type.__name__, "default": default, "choices": f.metadata.get("choices")})
    return out


@dataclass(frozen=True)
class Config:
    """Steps and their parameters, as plain data: {"steps": [...], "<step>": {...}}."""

    steps: tuple[str, ...] = ("assays", "tokens", "distributions")
    params: dict = field(default_factory=dict)
    run: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, spec: dict) -> Config:
        steps = tuple(spec.get("steps", cls.steps))
        for i, name in enumerate(steps):
            if name not in STAGES:
                raise ValueError(f"unknown step {name!r}")
            for need in STAGES[name].requires:
                if need not in steps[:i]:
                    raise ValueError(f"{name} needs {need} before it")
        if stray := [k for k in spec if k not in ("steps", "run", *RUN_KEYS, *STAGES)]:
            warnings.warn(f"unknown keys are ignored: {', '.join(map(str, stray))}", stacklevel=2)
        for i, name in enumerate(steps):
            if STAGES[name].place == "first" and i or STAGES[name].place == "last" and i < len(steps) - 1:
                warnings.warn(f"{name} should be the {STAGES[name].place} step", stacklevel=2)
        params, shared = {}, spec if spec.get("override_actor_params", True) else {}
        for name in steps:
            fields = {f.name for f in dataclasses.fields(STAGES[name].params)}
            spec = spec | {name: {k: v for k, v in shared.items() if k in fields and k not in STAGES} | dict(spec.get(name, {}))}
            given, known = spec.get(name, {}), {f.name for f in dataclasses.fields(STAGES[name].params)}
            if wrong := set(given) - known:
                raise ValueError(f"unknown parameters of {name}: {', '.join(sorted(wrong))}")
            params[name] = STAGES[name].params(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
        return cls(steps, params, {k: v for k, v in spec.items() if k in RUN_KEYS})

    @classmethod
    def load(cls, path: str) -> Config:
        """From a JSON or YAML file."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith((".yaml", ".yml")):
            import yaml

            return cls.from_dict(yaml.safe_load(text) or {})
        return cls.from_dict(json.loads(text))

    def save(self, path: str) -> None:
        plain = json.loads(json.dumps(self.to_dict(), default=dataclasses.asdict))
        with open(path, "w", encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                import yaml

                yaml.safe_dump(plain, f, sort_keys=False, allow_unicode=True)
            else:
                json.dump(plain, f, indent=1, ensure_ascii=False)

    def setting(self, name: str):
        return self.run.get(name, RUN_DEFAULTS[name])

    def to_dict(self) -> dict:
        return {"steps": list(self.steps)} | {n: dataclasses.asdict(self.params[n]) for n in self.steps} | self.run

    def hash(self) -> str:
        """Eight upper-case hex digits over everything but run settings; the order of keys doesn't matter."""
        spec = {k: v for k, v in self.to_dict().items() if k not in RUN_KEYS}
        return hashlib.sha256(json.dumps(spec, sort_keys=True, default=dataclasses.asdict).encode()).hexdigest()[:8].upper()

    def overridden(self, changes: list[str]) -> Config:
        """'step.key=value' changes; values are JSON where they can be, else text."""
        spec = self.to_dict()
        for change in changes:
            path, eq, raw = change.partition("=")
            step, dot, key = path.partition(".")
            if not eq or not dot:
                raise ValueError(f"not step.key=value: {change!r}")
            try:
                value = json.loads(raw)
            except ValueError:
                value = raw
            spec.setdefault(step, {})[key] = value
        return Config.from_dict(spec)


def run_steps(df: DataFrame, config: Config, ctx: RunContext | None = None, checkpoints: str | None = None, run_id: str | None = None) -> DataFrame:
    """Run the steps on df. With checkpoints, each step is written there and read again, which cuts its lineage."""
    ctx = ctx or RunContext()
    for name in config.steps:
        stage = STAGES[name]
        if df is not None:
            require_columns(df, list(stage.columns), name)
        df = stage.run(df, config.params[name], ctx)
        if checkpoints:
            path = f"{checkpoints}/{run_id or f'{ctx.input_id}_ID{config.hash()}'}_{name}"
            df.write.mode("overwrite").parquet(path)
            df = df.sparkSession.read.parquet(path)
    return df


@dataclass(frozen=True)
class Outcome:
    """What a run gave: its rows (the input of the step that failed, if one did), where they were written, and why it failed."""

    df: DataFrame | None
    run_id: str
    path: str | None = None
    error: str | None = None
    results: dict = field(default_factory=dict)


def run(spark, source, config: Config, input_id: str | None = None) -> Outcome:
    """Run a configuration on a frame, a file or a target id; write rows, configuration, reports and a log as it says.

    A step that raises, or leaves no row, ends the run. A run that failed writes no final table.
    """
    df, name, kind = resolve(spark, source, input_id)
    run_id = config.setting("run_id") or f"{name}_ID{config.hash()}"
    folder = f"{config.setting('output_root')}/{run_id}" if config.setting("write_output") else None
    log = report.logger(run_id, f"{folder}/{run_id}.log" if folder else None, config.setting("console_log_level"), config.setting("file_log_level"))
    ctx = RunContext(name, folder, spark)
    if folder:
        report.write_json(f"{folder}/{run_id}_config.json", report.run_config(config, name, kind))
    failed = None
    for step in config.steps:
        began = time.time()
        try:
            if df is None and step != config.steps[0]:
                raise ValueError("a target id needs the source step first")
            out = run_steps(df, dataclasses.replace(config, steps=(step,)), ctx, folder if config.setting("write_checkpoints") else None, run_id)
            if out.isEmpty():
                raise ValueError("no rows are left")
        except Exception as e:  # noqa: BLE001 - whatever a step raises ends the run, not the caller
            failed = f"{step}: {e}"
            log.error("%s failed: %s", step, e)
            break
        df = out
        log.info("%s done in %s", step, report.duration(time.time() - began))
    path = None
    if folder:
        for part, value in ctx.results.items():
            report.write_json(f"{folder}/{run_id}_{part}.json", value)
        if vocabulary := ctx.values.get("vocabulary"):
            vocabulary.save(f"{folder}/{run_id}_vocabulary.json")
        if not failed:
            path = f"{folder}/{run_id}.parquet"
            df.write.mode("overwrite").parquet(path)
            write_csv(spark.read.parquet(path), f"{folder}/{run_id}.csv")
    return Outcome(None if failed and config.setting("return_none_on_fail") else df, run_id, path, failed, ctx.results)


def run_batch(spark, sources: list, config: Config) -> dict[str, Outcome]:
    """Outcomes by input id; a repeated id gets a number."""
    out: dict[str, Outcome] = {}
    for source in sources:
        key = base = str(source) if not isinstance(source, DataFrame) else "frame"
        n = 1
        while key in out:
            n += 1
            key = f"{base}#{n}"
        out[key] = run(spark, source, config)
    return out
