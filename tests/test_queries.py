"""Every registered query outside llm against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import numpy as np
import pytest

from chalkline.plans import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "events documents embeddings pages labels conversations part".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (list, np.ndarray)):
        return [plain(v) for v in value]
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    return round(float(value), 8) if isinstance(value, (int, float, np.number)) else value


@pytest.mark.skipif(not Path(SF).is_dir(), reason="the driver's tables are not there")
@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, duck, name):
    got = Q.queries()[name](spark, SF)
    rows = [tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()]
    if name not in Q.oracle_sql():
        assert rows
        return
    relation = duck.sql(Q.oracle_sql()[name])
    assert sorted(relation.columns) == sorted(got.columns)
    at = [relation.columns.index(c) for c in sorted(got.columns)]
    wanted = [tuple(plain(r[i]) for i in at) for r in relation.fetchall()]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)


def test_the_package_works_without_llm():
    import ast

    root = Path(Q.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_line_share_crosses_blocks_of_ids(spark, tmp_path):
    ids = [(1, "a"), (999, "b"), (1000, "a"), (1001, "b"), (1002, "a"), (5000, "b"), (5001, "a"), (1500, None), (2500, None)]
    spark.createDataFrame([(i, s, f"same line\nline {i}") for i, s in ids], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.before_id for r in Q.line_share(spark, str(tmp_path)).collect()}
    assert got == {1000: 1, 1002: 1000, 5001: 1002, 1001: 999, 5000: 1001, 2500: 1500}
