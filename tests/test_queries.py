"""Every registered query with SQL is held against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from parcelwright.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text_of(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    return str(value)


def compare(spark, data, query, sql):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    df = query(spark, data)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(text_of, r)) for r in df.select(*columns).collect())
    found = connection.sql(sql)
    assert sorted(found.columns) == columns
    order = [found.columns.index(c) for c in columns]
    theirs = sorted(tuple(text_of(r[i]) for i in order) for r in found.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, data, name):
    compare(spark, data, QUERIES[name], ORACLES[name])


@pytest.fixture(scope="module")
def far_rows(data, tmp_path_factory):
    """The smallest tables with the suppliers' keys from 59,990 on, whose squares pass an int."""
    folder = tmp_path_factory.mktemp("far")
    for t in TABLES:
        (folder / f"{t}.parquet").symlink_to(f"{data}/{t}.parquet")
    (folder / "supplier.parquet").unlink()
    duckdb.execute(f"COPY (SELECT * REPLACE (s_suppkey + 59990 AS s_suppkey) FROM '{data}/supplier.parquet') TO '{folder}/supplier.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["q_block_metrics", "q_representative_points", "q_vectorization", "q_components", "q_mask_runs", "q_traced", "q_geometry_keys", "q_overlap_pairs", "q_holes", "q_union_area"])
def test_rows_far_down_the_mask(spark, far_rows, name):
    compare(spark, far_rows, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", ["q_match_pip", "q_match_metrics"])
def test_points_on_a_boundary(spark, data, tmp_path, name):
    """Two roles on the lower edge of a box, from whose projection onto it they differ by a rounding."""
    for t in TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{data}/{t}.parquet")
    (tmp_path / "customer.parquet").unlink()
    (tmp_path / "part.parquet").unlink()
    duckdb.execute(f"COPY (SELECT * REPLACE (76738 + row_number() OVER () - 1 AS c_custkey) FROM '{data}/customer.parquet' LIMIT 2) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    duckdb.execute(f"COPY (SELECT * REPLACE (102303::BIGINT AS p_partkey, 19::INT AS p_size) FROM '{data}/part.parquet' LIMIT 1) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    compare(spark, str(tmp_path), QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", ["q_holes"])
def test_tables_too_large_for_a_broadcast(spark, name):
    """Joins by shuffle leave both sides of a union dealt alike, of which a window over it must not depend."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    try:
        compare(spark, "/root/testdata/sf0.01", QUERIES[name], ORACLES[name])
    finally:
        spark.conf.set(threshold, before)


def test_keys_of_more_than_six_digits(spark, data, tmp_path):
    for t in TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{data}/{t}.parquet")
    (tmp_path / "events.parquet").unlink()
    duckdb.execute(f"COPY (SELECT * REPLACE (event_id + 999990 AS event_id) FROM '{data}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    compare(spark, str(tmp_path), QUERIES["q_props_flatten"], ORACLES["q_props_flatten"])


def test_registry(spark):
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    row = entry.entry(spark).collect()
    assert len(row) == 1 and row[0]["rows_total"] > 0
