"""Every registered query against its own SQL statement, and the registry as a whole."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
OWN_QUERIES, OWN_ORACLE = registry.QUERIES, registry.ORACLE
WITHOUT_SQL = {"file_manifest"}
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_registry_is_complete():
    assert set(OWN_QUERIES) - set(OWN_ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN_ORACLE))
def test_query_matches_sql(spark, duck, name):
    cursor = duck.execute(ORACLE[name])
    types = {c[0]: TYPES[str(c[1])] for c in cursor.description}
    names = [c[0] for c in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    found = QUERIES[name](spark, SF_DIR)
    assert dict(found.dtypes) == types
    columns = sorted(names)
    assert ordered([tuple(r[c] for c in columns) for r in found.collect()]) == ordered(
        [tuple(r[c] for c in columns) for r in expected]
    )
