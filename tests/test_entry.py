import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_sql_twin_has_a_query():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 130
    numbered = [name for name in queries if re.match(r"op\d", name)]
    assert not numbered or entry_module.training_data


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["doc_id", "rank", "term", "w"] and df.count() > 0


SAMPLE = ["tfidf", "rating_frequency", "box_stats", "cluster_score_table", "knn_predict", "auc", "ols", "dbscan", "hourly_histogram"]


@pytest.mark.parametrize("name", SAMPLE)
def test_sql_twins_on_the_smallest_tables(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = entry_module.queries()[name](spark, FOLDER)
    res = con.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in res.description]
    norm = lambda cols, rows: sorted(
        tuple(f"{r[cols.index(c)] + 0.0:.6g}" if isinstance(r[cols.index(c)], float) else str(r[cols.index(c)]) for c in sorted(cols)) for r in rows
    )
    assert sorted(df.columns) == sorted(names)
    assert norm(df.columns, [tuple(r) for r in df.collect()]) == norm(names, res.fetchall())


def test_no_local_checkpoint_or_cross_join_in_the_package():
    code = "\n".join(p.read_text() for p in (Path(__file__).parents[1] / "graniteflow").rglob("*.py"))
    assert "localCheckpoint" not in code and "crossJoin(" not in code
