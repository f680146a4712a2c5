"""The pipeline's stages, each against a plain version on its own input."""

import re
from collections import Counter, defaultdict

import duckdb
from helpers import near_components

import corpus_pipeline as CP
from plotline.llm import oracles
from plotline.llm.common import read
from plotline.llm.quality import quality_scores

SF = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = read(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in CP.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name] = docs, spark.read.parquet(f"{tmp_path}/{name}")
        docs = seen[name][1]
        assert docs.columns == columns + (["shard", "slot"] if name == "sharding" else [])

    before, after = seen["quality_classifier"]
    keep = {r.doc_id for r in quality_scores(before, read(spark, SF, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in after.collect()} == keep and 0 < len(keep) < before.count()

    before, after = seen["minhash_near_dedup"]
    want = {i for i, c in near_components([tuple(r) for r in before.collect()]).items() if i == c}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want) and len(want) < before.count()

    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    before, after = seen["benchmark_decontamination"]
    con.register("documents", before.toPandas())
    clean = con.execute(f"SELECT doc_id FROM ({oracles.DECONTAMINATE}) WHERE NOT contaminated").fetchall()
    assert sorted(r.doc_id for r in after.collect()) == sorted(x for (x,) in clean)

    before, after = seen["target_mixing"]
    con.register("documents", before.toPandas())
    sql = f"WITH {oracles.mixing_ctes('documents')} SELECT doc_id, copies FROM mix WHERE copies > 0"
    assert Counter(r.doc_id for r in after.collect()) == dict(con.execute(sql).fetchall())

    before, after = seen["sharding"]
    rows = after.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in before.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_run_equals_the_stages_and_is_registered(spark):
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is CP.run
    assert "pipeline" not in E.oracle_sql()
    first, again = (sorted((r.doc_id, r.shard, r.slot) for r in CP.run(spark, SF).collect()) for _ in range(2))
    assert [r[0] for r in first] == [r[0] for r in again]
    assert Counter(r[1] for r in first) == Counter(r[1] for r in again)


def test_registered_names():
    import __spark_entry__ as E

    found = [re.match(r"op(\d+)_", q) for q in E.queries()]
    assert sorted(int(m[1]) for m in found if m) == list(range(1, 11))
    assert set(oracles.SQL) <= set(E.queries())
