"""Corpus queries against their SQL twins."""

import random
from pathlib import Path

import duckdb
import pytest

from tickerloom.llm import queries

SF = "/root/testdata/sf0.001"
TWINS = sorted(queries.oracle_sql())
OF_DOCUMENTS = [name for name in TWINS if name != "op12_centroids"]


def compared(spark, name, folder):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        path = Path(str(folder)) / f"{table}.parquet"
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    twin = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in twin.description]
    found = queries.queries()[name](spark, str(folder))
    assert sorted(found.columns) == sorted(columns)
    expected = [tuple(map(repr, row)) for row in twin.fetchall()]
    actual = [tuple(map(repr, row)) for row in found.select(*columns).collect()]
    assert sorted(actual) == sorted(expected)
    return expected


@pytest.mark.parametrize("name", TWINS)
def test_query_equals_twin(spark, name):
    assert compared(spark, name, SF)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_twin_agrees_on_odd_rows(spark, docs, name, tmp_path):
    menu = "home\r\nabout\t\n\n"
    rows = [(1, None, "a"), (2, "", "b"), (3, "\n\n", None), (4, "one two\x0bthree", None),
            (5, " one two ", "b"), (5, "twin", "b"), (6, "word " * 4000, "c")]
    rows += [(i, f"{menu}own {i}\nsame  ", "m") for i in range(10, 40)]
    rows += [(i, f"{menu}copy", None) for i in range(50, 60)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert compared(spark, name, tmp_path)


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_twin_of_an_empty_table_is_empty(spark, docs, name, tmp_path):
    docs([(1, "a", "b")]).where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert not compared(spark, name, tmp_path)


def test_trees_of_several_stages_equal_the_twin(spark, docs, tmp_path):
    rows = [(i, f"Text {i}", "big" if i < 700 else f"s{i}") for i in range(1000)]
    rows += [(None, "No id", "big"), (3, "Other", "big"), (3, "Other", "big"), (9, None, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = compared(spark, "op13_manifest", tmp_path)
    assert {row[-1] for row in found} == {"True", "False"}


def test_odd_vectors_equal_the_twin(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(40)]            # copies of one vector
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (200, None), (201, []),
             (202, [1.0] * 63), (203, [None] + [1.0] * 63), (204, [float("nan")] * 64),
             (205, [float("inf")] + [0.0] * 63), (206, [0.0] * 64), (207, [-1000.5] * 64)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made.selectExpr("*", "1 AS cluster", "2 AS distance").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    assert len(compared(spark, "op12_centroids", tmp_path)) == 105
    few = tmp_path / "few"
    made.where("vec_id in (1, 2, 200)").write.parquet(str(few / "embeddings.parquet"))
    assert len(compared(spark, "op12_centroids", few)) == 2
    none = tmp_path / "none"
    made.where("vec_id = 200").write.parquet(str(none / "embeddings.parquet"))
    assert compared(spark, "op12_centroids", none) == []
