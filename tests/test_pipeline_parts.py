import http.server
import json
import sqlite3
import threading
import urllib.parse

import pytest

from ligandry.operators.assays import AssayParams
from ligandry.operators.vocabulary import Vocabulary
from ligandry.plans.pipeline import Config, RunContext, run_steps
from ligandry.sources import rest, sqlite, tables
from ligandry.streaming import rows
from tests.test_functions import ACTIVITY, activity


def test_sqlite_and_fetch(spark, tmp_path):
    path = str(tmp_path / "a.db")
    with sqlite3.connect(path) as c:
        c.executescript("""CREATE TABLE activities(activity_id INTEGER, assay_id INTEGER, molregno INTEGER, doc_id INTEGER, standard_value REAL);
        CREATE TABLE assays(assay_id INTEGER, tid INTEGER, assay_type TEXT, description TEXT, bao_format TEXT); CREATE TABLE target_dictionary(tid INTEGER, chembl_id TEXT, organism TEXT);
        CREATE TABLE molecule_dictionary(molregno INTEGER, chembl_id TEXT); CREATE TABLE compound_structures(molregno INTEGER, canonical_smiles TEXT); CREATE TABLE docs(doc_id INTEGER, year INTEGER, chembl_id TEXT);
        INSERT INTO target_dictionary VALUES (1, 'CHEMBL1', 'Homo sapiens'), (2, 'CHEMBL2', 'Mus'); INSERT INTO assays VALUES (10, 1, 'B', 'd', 'x'), (20, 2, 'B', 'd', 'x');
        INSERT INTO molecule_dictionary VALUES (5, 'M5'); INSERT INTO compound_structures VALUES (5, 'CCO'); INSERT INTO docs VALUES (7, 2020, 'D7');""")
        c.executemany("INSERT INTO activities VALUES (?, ?, ?, ?, ?)", [(i, 10 if i % 2 else 20, 5 if i % 3 else 6, 7, float(i)) for i in range(100)])
    read = {t: sqlite.read_table(spark, path, t, 4) for t in ("activities", "assays", "target_dictionary", "molecule_dictionary", "compound_structures", "docs")}
    assert read["activities"].count() == 100 and read["activities"].where("activity_id >= 90").count() == 10
    found = tables.fetch(read, "CHEMBL1", limit=20).collect()
    assert [r.activity_id for r in found] == list(range(1, 40, 2)) and {r.canonical_smiles for r in found} == {"CCO", None}
    (tmp_path / "b.db").write_text("no")
    with pytest.raises(ValueError):
        sqlite.verify(str(tmp_path / "b.db"))


def test_rest(spark):
    fails = [1]

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if fails:
                fails.pop()
                self.send_error(500)
                return
            q = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query))
            at, n = int(q["offset"]), int(q["limit"])
            body = json.dumps({"page_meta": {"total_count": 25}, "activities": [{"id": i, "x": None} for i in range(at, min(25, at + n))]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/a"
    quick = {"page": 10, "delay": 0, "wait": 0}
    assert sorted(int(r.id) for r in rest.read_pages(spark, url, "activities", ["id", "x"], **quick).collect()) == list(range(25))
    assert rest.read_pages(spark, url, "activities", ["id"], n=12, **quick).count() == 12
    server.shutdown()


def test_config_and_steps(spark, tmp_path):
    a = Config.from_dict({"assays": {"standard_type": "IC50"}, "steps": ["assays", "tokens"]})
    b = Config.from_dict({"steps": ["assays", "tokens"], "output_root": "elsewhere"})
    assert a.hash() == b.hash() and a.overridden(["assays.standard_type=Ki"]).params["assays"].standard_type == "Ki"
    with pytest.raises(ValueError):
        Config.from_dict({"assays": {"typo": 1}})
    with pytest.raises(ValueError):
        Config.from_dict({"steps": ["nothing"]})
    df = spark.createDataFrame([activity("CCO", "100"), activity("c1ccccc1", "200")], ACTIVITY)
    ctx = RunContext("t")
    out = run_steps(df, Config.from_dict({"distributions": {"thresholds": {"seqlen": {"max_value": 7}}}}), ctx, str(tmp_path))
    assert [r.canonical_smiles for r in out.collect()] == ["CCO"] and "C" in ctx.values["vocabulary"]
    with pytest.raises(ValueError):
        run_steps(df.drop("document_year"), a)


def test_inputs(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    df, name, kind = tables.resolve(spark, str(tmp_path / "x.csv"))
    assert (df.count(), name, kind) == (1, "x", "csv") and tables.resolve(spark, "CHEMBL25")[2] == "target"
    with pytest.raises(ValueError):
        tables.resolve(spark, df)


def test_stream(spark, tmp_path):
    spark.createDataFrame([activity("CCO", "100"), activity("CN", "1", standard_type="Ki")], ACTIVITY).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ACTIVITY).parquet(str(tmp_path / "in"))
    v, seen = Vocabulary(), []
    q = rows.grow_vocabulary(rows.standardised(stream, AssayParams()), v, str(tmp_path / "cp"), lambda b, _: seen.extend(b.collect()))
    q.awaitTermination(120)
    assert [r.pIC50 for r in seen] == [7.0] and "O" in v and "N" not in v
