import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from orderlake.llm import queries

CHECKED = sorted(queries.ORACLE_SQL)


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{file}')")
    return con


def values(rows):
    return sorted([tuple(row) for row in rows], key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, tables, name):
    df = queries.QUERIES[name](spark, sf_dir)
    wanted = tables.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(df.columns) == sorted(columns)
    assert values(df.select(*columns).collect()) == values(wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(CHECKED)))
def test_query_gives_a_row_per_document(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.QUERIES[name](spark, sf_dir)
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(
        r[0] for r in docs.select("doc_id").collect()
    )


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mixture", "encoded"]
