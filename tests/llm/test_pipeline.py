"""The pipeline and the registered queries over the smoke tables."""

import os

import pytest

SMOKE = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SMOKE), reason="no smoke data")


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert {"op6_exact_dedup", "op10_substring_dedup"} <= set(E.oracle_sql())


@needs_data
def test_stages(spark):
    import corpus_pipeline as C
    from boxscore.llm.common import documents

    docs = documents(spark, SMOKE)
    columns, n = docs.columns, docs.count()
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SMOKE)
        assert docs.columns == columns, name
        rows = docs.collect()
        assert 0 < len(rows) <= n
        docs, n = spark.createDataFrame(rows, docs.schema), len(rows)
    pieces = C.STAGES[-1][1](spark, docs, SMOKE).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in rows}
    assert len(C.run(spark, SMOKE).collect()) >= len(rows)


@needs_data
@pytest.mark.parametrize("name", ["op6_exact_dedup", "op10_substring_dedup"])
def test_oracles(spark, name):
    import duckdb

    import __spark_entry__ as E
    from tools.check_oracle import digest, rows_of

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMOKE}/documents.parquet')")
    df = E.queries()[name](spark, SMOKE)
    got, names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    want, other = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert names == other and digest(got) == digest(want)
