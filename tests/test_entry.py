import os

import pytest

SMOKE = "/root/testdata/sf0.001"


def test_registry_and_oracle_keys_agree():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="no smoke data")
def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 100 and any(r["score"] is not None for r in rows) and any(r["goal"] is not None for r in rows)


@pytest.mark.skipif(not os.path.exists(SMOKE), reason="no smoke data")
@pytest.mark.parametrize("name", ["q_top_box", "q_dual_date_left", "q_goal_cascade", "q_percentile_lookup",
                                  "q_locations", "q_rollup_lines"])
def test_oracle_matches_at_smoke_scale(spark, name):
    import duckdb

    import __spark_entry__ as E
    from tools.check_oracle import TABLES, digest, rows_of
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = E.queries()[name](spark, SMOKE)
    sr, sc = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(E.oracle_sql()[name])
    dr, dc = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc and len(sr) == len(dr) and digest(sr) == digest(dr)
