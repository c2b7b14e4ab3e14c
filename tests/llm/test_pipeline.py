"""The registered queries against SQL, and the pipeline stage by stage."""

import importlib.util
import os

import duckdb
import pytest
from conftest import SF

import corpus_pipeline
from sievewright.llm import decontamination, line_dedup, queries, quality_rules, simhash
from sievewright.storage import Workspace

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_registration():
    spec = importlib.util.spec_from_file_location("entry_for_llm", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = entry.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM '{SF}/{file}'")
    cursor = connection.execute(queries.ORACLES[name])
    columns = sorted(d[0] for d in cursor.description)
    got = queries.REGISTRY[name](spark, SF)
    assert sorted(got.columns) == columns
    pick = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in pick) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == expected


def test_stages(shipped, space):
    """Each stage keeps or changes what its operator says on its own input, and the last places every piece."""
    docs = shipped.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = after = space.hold(stage(shipped, before, SF), name)
        if name != "best_fit_packing":
            assert after.columns == names
        ids = {r["doc_id"] for r in before.select("doc_id").collect()}
        left = [r["doc_id"] for r in after.select("doc_id").collect()]
        assert set(left) <= ids
        if name == "quality_rules":
            labels = shipped.read.parquet(f"{SF}/labels.parquet")
            assert set(left) == {r["doc_id"] for r in quality_rules.report(docs, labels).collect() if r["kept"]}
        elif name == "line_dedup":
            whole = line_dedup.dedup(before, Workspace(shipped, "test")).select("doc_id", "text").collect()
            texts = {r["doc_id"]: r["text"] for r in whole}
            assert all(texts[r["doc_id"]] == r["text"] and len(r["text"]) == r["n_chars"] for r in after.collect())
            assert all(not texts[i].strip() for i in ids - set(left))
        elif name == "simhash":
            groups = simhash.report(before, Workspace(shipped, "test")).collect()
            assert sorted(left) == sorted({r["component_id"] for r in groups})
        elif name == "decontamination":
            judged = decontamination.report(before, shipped.read.parquet(f"{SF}/benchmark.parquet"), Workspace(shipped, "test")).collect()
            assert sorted(left) == sorted(r["doc_id"] for r in judged if not r["contaminated"])
        else:
            assert set(left) == ids
        before = after
    assert [c for c in corpus_pipeline.run(shipped, SF).columns] == found["best_fit_packing"].columns


def test_benchmark_items_without_id(shipped, tmp_path):
    """As the SQL has it: their words count, their ids do not; the pipeline drops what holds only such passages."""
    word = lambda k, n: " ".join(f"{k}{chr(97 + i)}" for i in range(n))
    benchmark = [(None, word("p", 15)), (None, word("q", 13)), (7, word("r", 14)), (8, word("q", 13)), (None, word("s", 3)), (9, None), (None, "")]
    texts = [word("p", 15), word("x", 5) + " " + word("p", 13), word("q", 13), word("p", 14) + " " + word("q", 13) + " " + word("r", 14),
             word("r", 14), word("s", 3) + " " + word("y", 90), word("z", 20), None]
    shipped.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shipped.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    expected = sorted(connection.execute(queries.ORACLES["op4_decontamination"]).fetchall())
    assert [r[2] > 0 for r in expected] == [True] * 6 + [False] * 2
    assert sorted(tuple(r) for r in queries.REGISTRY["op4_decontamination"](shipped, str(tmp_path)).collect()) == expected
    docs = shipped.read.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in corpus_pipeline.without_benchmark(shipped, docs, str(tmp_path)).collect()) == [r[0] for r in expected if not r[5]]


def test_stages_on_odd_rows(shipped, space, odd, none, tmp_path):
    folder = str(tmp_path)
    shipped.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    shipped.createDataFrame([(1, "nothing of this stands anywhere in them")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for k, docs in enumerate((odd, none)):
        for name, stage in corpus_pipeline.STAGES:
            after = space.hold(stage(shipped, docs, folder), f"{name}{k}")
            if name != "best_fit_packing":
                assert after.columns == docs.columns
            docs = after
