"""Whole runs: stages in order, reports, configuration files, command line."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ligandry import cli
from ligandry.operators import distributions, split
from ligandry.plans import pipeline, report, stages
from ligandry.plans.pipeline import TEMPLATES, Config, RunContext
from ligandry.queries import QUERIES
from tests.test_functions import ACTIVITY, activity

SMILES = ["Cc1ccccc1", "CCc1ccccc1", "Oc1ccccc1", "c1ccc2ccccc2c1", "Cc1ccc2ccccc2c1", "C1CCCCC1", "CC1CCCCC1", "c1ccncc1", "c1ccc(cc1)-c1ccccc1", "CCO", "CCCC", "bad("]


def molecules(spark):
    return spark.createDataFrame([(s, f"M{i}", float(i)) for i, s in enumerate(SMILES)], "canonical_smiles string, molecule_id string, value double")


def spec(**split_how):
    return {"steps": ["curate", "scaffold", "split"], "curate": {"dropna": False, "check_duplicates": False, "kernel": "lite"}, "scaffold": {"kernel": "lite"}, "split": {"kernel": "lite", "activity_column": "value", **split_how}, "write_output": False, "console_log_level": "ERROR"}


@pytest.mark.parametrize("how", [{"method": "isolation"}, {"method": "random", "seed": 3}, {"unit": "molecule", "test_ratio": 0.2}])
def test_split_stage(spark, how):
    runs = [pipeline.run(spark, molecules(spark).repartition(n), Config.from_dict(spec(**how)), "m") for n in (1, 3)]
    assert runs[0].error is None
    rows = [sorted((r.molecule_id, r.split) for r in o.df.collect()) for o in runs]
    assert rows[0] == rows[1] and {s for _, s in rows[0]} <= {"train", "val", "test"} and len(rows[0]) == 12
    labels = dict(rows[0])
    if how.get("unit") != "molecule":
        assert all(labels[m] == "train" for m in ("M9", "M10", "M11")) and labels["M0"] == labels["M1"] == labels["M2"]
        assert not any(runs[0].results["split"]["overlap"].values())
    got = runs[0].results["split"]
    assert sum(r["n"] for r in got["composition"].values()) == 12 and sum(r["n_failed"] for r in got["fingerprints"].values()) == 1 and "ks" in got


def test_split_limits(spark):
    too_many = pipeline.run(spark, molecules(spark), Config.from_dict(spec(max_units_for_isolation=2)), "m")
    assert "units" in too_many.error
    for wrong in ({"test_ratio": 0.9, "val_ratio": 0.2}, {"val_label": "train"}, {"method": "other"}):
        with pytest.raises(ValueError):
            Config.from_dict(spec(**wrong))


def test_blocked_distances_against_loops(spark):
    rng = random.Random(2)
    rows = [(i, [rng.getrandbits(64) - 2**63 if rng.random() < 0.9 else 0 for _ in range(2)], rng.randint(1, 5), rng.choice("xyz")) for i in range(700)] + [(900, None, 1, "x"), (901, [0, 0], 1, "x")]
    df = spark.createDataFrame(rows, "id long, bits array<long>, size int, split string").repartition(3)
    known = {r[0]: r for r in rows if r[1]}

    def distance(a, b):
        x, y = ([w & 2**64 - 1 for w in known[k][1]] for k in (a, b))
        either = sum((p | q).bit_count() for p, q in zip(x, y))
        return 1 - (sum((p & q).bit_count() for p, q in zip(x, y)) / either if either else 0)

    some = rng.sample(sorted(known), 12) + [901]
    scores = {r.id: r.score for r in split.isolation(df).collect()}
    near = {(r.id, r.reference): r.d for r in split.nearest(df).collect()}
    assert set(scores) == set(known)
    for a in some:
        others = [b for b in known if b != a]
        assert scores[a] == pytest.approx(sum(distance(a, b) * known[b][2] for b in others) / sum(known[b][2] for b in others))
        for s in "xyz":
            assert near[a, s] == pytest.approx(min(distance(a, b) for b in others if known[b][3] == s))
    pairs = {(r.a, r.b): r.distance for r in split.pairs(df.where("id < 40")).collect()}
    assert len(pairs) == 40 * 39 // 2 and all(d == pytest.approx(distance(a, b)) for (a, b), d in pairs.items())
    with pytest.raises(ValueError):
        split.pairs(df, max_units=10)


def test_components_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, 3)) @ rng.standard_normal((3, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(99, None, 1.0, 2.0)], "i int, a double, b double, c double")
    found, explained = distributions.with_components(df, ["a", "b", "c"])
    z = (x - x.mean(0)) / x.std(0)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    got = {r.i: (r.distribution_pca_x, r.distribution_pca_y) for r in found.collect()}
    assert got[99] == (None, None) and explained == pytest.approx((s**2 / (s**2).sum())[:2].tolist())
    for k in range(2):
        assert np.allclose(np.abs([got[i][k] for i in range(60)]), np.abs(u[:, k] * s[k]))


def test_full_run_with_files(spark, tmp_path):
    rows = [activity(s, str(100 * (i + 1))) for i, s in enumerate(["CCO", "CCO.[Na+]", "c1ccccc1", "CCN", "C1CCCCC1C"])]
    config = Config.from_dict({"steps": ["assays", "curate", "tokens", "distributions"], "curate": {"kernel": "lite"}, "tokens": {"smiles_column": "curated_smiles"}, "distributions": {"kernel": "lite", "properties": ["num_atoms", "num_tokens"], "thresholds": {"num_atoms": {"max_value": 6}}, "perform_pca": True}, "output_root": str(tmp_path), "write_checkpoints": True, "console_log_level": "ERROR"})
    done = pipeline.run(spark, spark.createDataFrame(rows, ACTIVITY), config, "t")
    assert done.error is None and done.path
    kept = {r.canonical_smiles for r in spark.read.parquet(done.path).collect()}
    assert "C1CCCCC1C" not in kept and "c1ccccc1" in kept
    names = {p.name for p in (tmp_path / done.run_id).iterdir()}
    assert {f"{done.run_id}{x}" for x in (".csv", ".log", "_config.json", "_distributions.json", "_vocabulary.json", "_curate")} <= names
    shown = json.loads((tmp_path / done.run_id / f"{done.run_id}_distributions.json").read_text())
    assert shown["report"]["funnel"]["retained"] == len(kept) and shown["report"]["properties"]["num_atoms"]["threshold"] == "≤6"
    nothing = pipeline.run(spark, spark.createDataFrame(rows, ACTIVITY), config.overridden(["assays.standard_type=Ki"]), "t")
    assert "no rows" in nothing.error and nothing.path is None


def test_source_stage(spark, tmp_path):
    made = {"activities": "1 AS activity_id, 10 AS assay_id, 5 AS molregno, 7 AS doc_id, 3.0 AS standard_value", "assays": "10 AS assay_id, 1 AS tid, 'B' AS assay_type, 'd' AS description, 'x' AS bao_format, 'liver' AS assay_tissue", "target_dictionary": "1 AS tid, 'CHEMBL1' AS chembl_id, 'Homo sapiens' AS organism, 'JAK2' AS pref_name", "molecule_dictionary": "5 AS molregno, 'M5' AS chembl_id", "compound_structures": "5 AS molregno, 'CCO' AS canonical_smiles", "docs": "7 AS doc_id, 2020 AS year, 'D7' AS chembl_id, 'J' AS journal"}
    for t, columns in made.items():
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / f"{t}.parquet"))
    config = Config.from_dict({"steps": ["source"], "source": {"db_path": str(tmp_path)}, "write_output": False, "console_log_level": "ERROR"})
    row = pipeline.run(spark, "CHEMBL1", config).df.first()
    assert (row.canonical_smiles, row.target_pref_name, row.assay_tissue, row.journal, row.document_year) == ("CCO", "JAK2", "liver", "J", 2020)
    assert "no rows" in pipeline.run(spark, "CHEMBL9", config).error


def test_configuration_files(tmp_path):
    for name in TEMPLATES:
        config = Config.from_dict(TEMPLATES[name])
        for ending in ("json", "yaml"):
            config.save(str(tmp_path / f"c.{ending}"))
            assert Config.load(str(tmp_path / f"c.{ending}")).hash() == config.hash()
    with pytest.warns(UserWarning, match="unknown keys"):
        Config.from_dict({"stepz": []})
    with pytest.warns(UserWarning, match="first step"):
        Config.from_dict({"steps": ["tokens", "source"]})
    shared = Config.from_dict({"steps": ["curate", "scaffold"], "kernel": "lite", "scaffold": {"kernel": None}})
    assert shared.params["curate"].kernel == "lite" and shared.params["scaffold"].kernel is None
    for wrong in ({"steps": ["split"]}, {"curate": {"mol_steps": ["desalt", "desalt"]}, "steps": ["curate"]}, {"source": {"n": 0}, "steps": ["source"]}):
        with pytest.raises(ValueError):
            Config.from_dict(wrong)
    (tmp_path / "plugin.py").write_text("from dataclasses import dataclass\nfrom ligandry.plans.pipeline import Stage\n@dataclass(frozen=True)\nclass P:\n    n: int = 3\nSTAGE = Stage('extra', lambda df, p, ctx: df.limit(p.n), P)\n")
    assert pipeline.discover(str(tmp_path)) == ["extra"] and pipeline.describe("extra") == [{"name": "n", "type": "int", "default": 3, "choices": None}]
    del pipeline.STAGES["extra"]
    assert stages.molecule_provider(("curate", "confs")) == "confs"


def test_command_line(tmp_path, capsys):
    path = str(tmp_path / "c.yaml")
    assert cli.main(["init", path, "--template", "full"]) == 0 and cli.main(["validate", path, "--diagram"]) == 0
    assert "scaffold -> split" in capsys.readouterr().out
    assert cli.main(["info", "split"]) == 0 and "test_ratio" in capsys.readouterr().out
    assert cli.main(["run", "a.csv", "b.csv", "--output", str(tmp_path)]) == 1 and cli.main(["validate", str(tmp_path / "none.json")]) == 1 and cli.main(["info", "nothing"]) == 1
    answers = iter(["n"] * 3 + ["y"] + ["n"] * 20)
    assert cli.ask(answer=lambda q: next(answers, "") if "?" in q else "")["steps"] == ["tokens"]


def test_texts():
    assert [report.duration(s) for s in (3.24, 65, 3723)] == ["3.2s", "1m 5.0s", "1h 2m 3.0s"]
    t = distributions.Threshold(statistical_lower=-2.0, max_value=30)
    assert report.threshold_text(t, (0.234, 30.0)) == "≥μ-2.0σ (0.23), ≤30"


def test_plot_data(spark):
    got = report.plot_data(spark.range(1000).select(F.col("id").cast("double").alias("v")), "v", 10, 9)
    assert sum(b["n"] for b in got["histogram"]) == 980 and len(got["qq"]) == 9 and got["qq"][4][1] == pytest.approx(499.5)
    assert isinstance(RunContext().results, dict)


@pytest.fixture(scope="module")
def many_units(spark):
    """More units than a tile holds and than are compared unasked (one word, size, split), and the distances of some of them to all."""
    import numpy as np

    rng = np.random.default_rng(5)
    words, size = rng.integers(-(2**63), 2**63 - 1, 10_400), rng.integers(1, 5, 10_400)
    words[:50], words[50] = words[0], 0
    rows = [(i, [int(w)], int(n), "xyz"[i % 7 % 3]) for i, (w, n) in enumerate(zip(words, size))]
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
    some = [*range(0, 60, 7), 50, *range(99, 10_400, 99)]
    both = bits[some] @ bits.T
    distances = dict(zip(some, 1 - both / np.maximum(bits[some].sum(1)[:, None] + bits.sum(1) - both, 1)))
    return spark.createDataFrame(rows, "id long, bits array<long>, size long, split string"), distances, size


def test_isolation_of_any_number_of_units(spark, many_units):
    df, distances, size = many_units
    got = {r.id: r.score for r in split.isolation(df, None).collect()}
    assert len(got) == len(size)
    for i, d in distances.items():
        assert got[i] == pytest.approx((d @ size - d[i] * size[i]) / (size.sum() - size[i]), abs=1e-12)
    alone = split.isolation(df.where("id = 9"), None).collect()
    assert [(r.id, r.score) for r in alone] == [(9, 0.0)] and split.isolation(df.where("id < 0"), None).count() == 0


def test_nearest_of_any_number_of_units(spark, many_units):
    import numpy as np

    df, distances, _ = many_units
    got = {(r.id, r.reference): r.d for r in split.nearest(df, None).collect()}
    assert len(got) == 3 * df.count()
    of = np.array(["xyz"[i % 7 % 3] for i in range(df.count())])
    for i, d in distances.items():
        d = np.where(np.arange(len(d)) == i, np.inf, d)
        for s in "xyz":
            assert got[i, s] == d[of == s].min()
    summary = {(r.query, r.reference): r.n for r in split.nearest_summary(df, None).collect()}
    assert summary == {(q, r): int((of == q).sum()) for q in "xyz" for r in "xyz"}


def test_queries_on_more_units_than_compared_unasked(spark, many_units, tmp_path):
    df, _, _ = many_units
    signs = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.when(F.call_function("shiftright", F.col("bits")[0], k).bitwiseAND(1) == 1, 1.0).otherwise(-1.0).cast("float"))
    df.select(F.col("id").alias("vec_id"), signs.alias("embedding"), (F.col("size") - 1).cast("int").alias("label")).write.parquet(str(tmp_path / "embeddings.parquet"))
    sizes = dict(df.select("id", "size").collect())
    scores = {r.id: r.score for r in QUERIES["isolation_scores"](spark, str(tmp_path)).collect()}
    got = {r.id: r.split for r in QUERIES["split_isolation"](spark, str(tmp_path)).collect()}
    share, at, known = round(sum(sizes.values()) * 0.1), {"test": 0, "val": 0}, {}
    for i in sorted(sizes, key=lambda i: (scores[i], i), reverse=True):
        known[i] = next((s for s in at if at[s] < share), "train")
        if known[i] in at:
            at[known[i]] += sizes[i]
    assert got == known


def test_pairs_of_any_number_of_units(spark, many_units):
    df, distances, size = many_units
    some = [*distances][:3] + [50, 9999]
    of = [F.sum(F.when((F.col("a") == i) | (F.col("b") == i), F.col("distance"))) for i in some]
    n, ordered, *sums = split.pairs(df, None).agg(F.count("*"), F.count_if(F.col("a") < F.col("b")), *of).first()
    assert n == ordered == len(size) * (len(size) - 1) // 2
    assert sums == pytest.approx([distances[i].sum() - distances[i][i] for i in some])
    few = split.pairs(df.where("id < 2200"), None).where(F.col("a").isin(*some) | F.col("b").isin(*some)).collect()
    got = {(r.a, r.b): r.distance for r in few}
    assert len(few) == len(got) and got == {(min(i, j), max(i, j)): distances[i][j] for i in some if i < 2200 for j in range(2200) if i != j}
