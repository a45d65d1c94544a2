import math
import re

import pytest
from pyspark.sql import functions as F

from ligandry.functions import columns as fn
from ligandry.operators import assays, distributions, split
from ligandry.operators.vocabulary import Vocabulary
from ligandry.registry import conversion, label_column, measurement

ACTIVITY = "canonical_smiles string, standard_value string, standard_units string, standard_type string, standard_relation string, standard_flag int, potential_duplicate int, pchembl_value double, data_validity_comment string, document_year int, document_chembl_id string, molecule_chembl_id string, assay_type string, assay_description string, target_organism string, bao_format string"


def activity(smiles, value, year=2020, **changes):
    row = dict(canonical_smiles=smiles, standard_value=value, standard_units="nM", standard_type="IC50", standard_relation="=", standard_flag=1, potential_duplicate=0, pchembl_value=7.0, data_validity_comment=None, document_year=year, document_chembl_id="D1", molecule_chembl_id="M1", assay_type="B", assay_description="binding", target_organism="Homo sapiens", bao_format="BAO_0000357")
    return tuple((row | changes).values())


def test_curation(spark):
    rows = [
        activity("CCO", "100"),
        activity("c1ccccc1", "200", 2021),
        activity("CN", "10", 2021),
        activity("CN", "12", 2019),
        activity("bad", "1"),
        activity("bad", "1000"),  # three log units apart
        activity("wide", "1"),
        activity("wide", "100"),
        activity("mut", "5", assay_description="a V617F Mutant"),
        activity("none", None),
        activity("text", "n/a"),
        activity("zero", "0"),
        activity("nodesc", "10", assay_description=None),
        activity("ki", "10", standard_type="Ki"),
    ]
    df = spark.createDataFrame(rows, ACTIVITY)
    got = {r.canonical_smiles: r for r in assays.curate(df, assays.AssayParams()).collect()}
    assert set(got) == {"CCO", "c1ccccc1", "CN", "nodesc"}
    assert got["CCO"].pIC50 == pytest.approx(7.0) and got["c1ccccc1"].pIC50 == pytest.approx(6.69897, abs=1e-5)
    assert got["CN"].document_year == 2019 and got["CN"]["count"] == 2 and got["CCO"]["std"] == 0


def test_repeated_values_count_beyond_mistakes(spark):
    rows = [activity("same", "10"), activity("same", "10", 2021), activity("near", "10"), activity("near", "10.0001"), activity("CN", "10"), activity("CN", "12"), activity("CCO", "100")]
    df = spark.createDataFrame(rows, ACTIVITY)
    kept = lambda **p: {r.canonical_smiles for r in assays.curate(df, assays.AssayParams(**p)).collect()}
    assert kept() == {"same", "near", "CN", "CCO"} and kept(mistakes_only=False) == {"CN", "CCO"}


def test_units_and_labels():
    assert conversion("nM") == 1e9 and -math.log10(1 / conversion("uM")) == pytest.approx(6)
    assert label_column("Ki") == "pKi" and label_column("Log D") == "Log D"
    with pytest.raises(ValueError):
        measurement("nonsense")


def test_tokens(spark):
    texts = ["CCO", "c1ccccc1", "[nH]%12Br", "ClC\nN", "", None, "^a$b"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", fn.tokenize(F.col("s")).alias("t"))
    for r in df.select("s", "t", fn.untokenize(F.col("t")).alias("u")).collect():
        want = ["^", *re.findall(r"(?s)\[[^\]]*\]|%[0-9]{2}|Br|Cl|.", r.s), "$"] if r.s else []
        assert r.t == want
        assert r.u == (r.s.split("$")[0].replace("^", "") if r.s else "")
    v = Vocabulary.from_frame(df, "t")
    assert v.tokens()[:3] == ["*", "^", "$"] and v.get("missing") is None
    ids = df.select("t", fn.encode(F.col("t"), v.as_map()).alias("i")).select("t", fn.decode(F.col("i"), v.as_inverse_map()).alias("back")).collect()
    assert all(r.t == r.back for r in ids)


def test_vocabulary_file(tmp_path):
    v = Vocabulary.build("NOCC")
    v.save(str(tmp_path / "v.json"))
    assert Vocabulary.load(str(tmp_path / "v.json")) == v and len(v) == 3 + 3 + 6
    v.delete("N")
    assert "N" not in v and v.ids["O"] == v.tokens().index("O")


def test_failure_flags(spark):
    rows = [("pass", ["C", "C", "O"], 10.0, 2.0), ("atoms_high", ["C", "O"], 40.0, 2.0), ("atoms_low", ["C", "O"], 3.0, 2.0), ("logp_high", ["C", "O"], 10.0, 5.0), ("oov", ["C", "O", "Q"], 10.0, 2.0), ("rare", ["C", "O", "Z"], 10.0, 2.0), ("nan", ["C"], float("nan"), 2.0), ("notokens", None, 10.0, 2.0)]
    df = spark.createDataFrame(rows, "molecule_id string, tokens array<string>, num_atoms double, logp double")
    flagged = distributions.curate(df, {"num_atoms": (5.0, 30.0), "logp": (None, 4.0)}, vocabulary="COZ", rare=["Z", "Q"], drop=False)
    got = {r.molecule_id: (r.failures, r.success) for r in flagged.collect()}
    assert got["pass"] == ("", True) and got["atoms_high"] == ("num_atoms:high", False) and got["atoms_low"] == ("num_atoms:low", False)
    assert got["logp_high"] == ("logp:high", False) and got["oov"] == ("tokens:unknown; tokens:rare", False) and got["rare"] == ("tokens:rare", False)
    assert got["nan"] == ("", False) and got["notokens"][1] is False


def test_greedy_fill_against_loop(spark):
    import random

    rng = random.Random(3)
    for _ in range(5):
        sizes = [rng.randint(1, 9) for _ in range(rng.randint(3, 25))]
        n, t_sum, v_sum, want = sum(sizes), 0, 0, []
        t = v = max(1, round(n * 0.1))
        for s in sizes:
            if t_sum < t:
                t_sum += s
                want.append("test")
            elif v_sum < v:
                v_sum += s
                want.append("val")
            else:
                want.append("train")
        df = spark.createDataFrame(list(enumerate(sizes)), "pos long, size long")
        assert [r.split for r in split.greedy_fill(df, F.col("pos"), n).orderBy("pos").collect()] == want


def test_limits_and_statistics():
    with pytest.raises(ValueError):
        distributions.Threshold(min_value=2, max_value=1)
    assert distributions.normality(100, 0.0, 0.0)["normal"] and not distributions.normality(500, 2.0, 5.0)["normal"]
    assert split.ks_p_value(0.0, 50, 50) == 1.0 and split.ks_p_value(0.9, 50, 50) < 1e-6
