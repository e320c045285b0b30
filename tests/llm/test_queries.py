import os

import duckdb
import pytest
from pyspark.sql import functions as F

from leafwright.llm import queries
from leafwright.session import table


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf).cache()
    n, results, documents = df.count(), table(spark, sf, "results").count(), table(spark, sf, "documents").count()
    if name.endswith("_found"):
        assert 0 < n == df.distinct().count()
    whole = {"p1_clean": results, "p2_texts": results, "p5_labels": results, "p8_ids": documents, "p8_texts": documents}
    assert n == whole.get(name, n)
    if name == "p5_languages":
        assert df.select("result_id").distinct().count() == results
    if name == "p9_limits":
        assert {r.n_over for r in df.collect()} == {0} and n == table(spark, sf, "containers").count()
    if name in queries.SQL:
        cols = sorted(df.columns)
        cur = duck.execute(queries.SQL[name])
        have = [d[0] for d in cur.description]
        assert sorted(have) == cols
        assert sorted(str([r[c] for c in cols]) for r in df.collect()) == sorted(str([r[have.index(c)] for c in cols]) for r in cur.fetchall())


def test_found_and_reported_agree(spark, sf):
    run = lambda name: queries.QUERIES[name](spark, sf)
    pairs = {tuple(r) for r in run("p2_found").collect()}
    of = {r.result_id: r for r in run("p2_classes").collect()}
    assert pairs == {(a, b) for a in of for b in of if a < b and of[a].class_id == of[b].class_id and of[a].form_id != of[b].form_id}
    same = {r.result_id: r.text for r in run("p2_texts").collect()}
    assert all(same[a] == same[b] for a, b in pairs)
    assert run("p6_sources").agg(F.sum("n_cut")).first()[0] == run("p6_found").count()
    assert {r[0] for r in run("p3_found").collect()} == {r.result_id for r in run("p3_shares").where("repeated_share > 0.5").collect()}
    assert {r[0] for r in run("p10_found").collect()} == {r[0] for r in run("p10_restored").select("doc_id").collect()}
    changed = run("p1_clean").withColumnRenamed("text", "clean").join(table(spark, sf, "results"), "result_id").where("clean <> text").select("result_id")
    assert {r[0] for r in changed.collect()} <= {r[0] for r in run("p1_found").collect()}
