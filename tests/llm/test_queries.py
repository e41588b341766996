"""The registered text queries against SQL, the pipeline stage by stage, and the guard of the registry."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from ebbtide.llm.oracle import ORACLE
from ebbtide.llm.queries import QUERIES
from ebbtide.llm.quality import quality_scores
from tests.llm.test_dedup import brute_components, brute_repeats

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def test_each_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries()) and set(ORACLE) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    found = QUERIES[name](spark, SF_DIR)
    assert dict(found.dtypes) == {c[0]: TYPES[str(c[1])] for c in cursor.description}
    expected = sorted(str(r) for r in cursor.fetchall())
    assert sorted(str(tuple(r[c] for c in names)) for r in found.collect()) == expected


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_duplicates", "repeats", "packing"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = stages["quality"](spark, docs, SF_DIR)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    lines = stages["line_dedup"](spark, good, SF_DIR).cache()
    texts = {r.doc_id: r.text for r in good.collect()}
    for r in lines.collect():  # what is left are lines of the document in their order
        rest = iter(texts[r.doc_id].split("\n"))
        assert all(line in rest for line in r.text.split("\n")) and r.n_chars == len(r.text)
    apart = stages["near_duplicates"](spark, lines, SF_DIR).cache()
    expected = brute_components([(r.doc_id, r.text) for r in lines.collect()], 5, 80)
    assert {r.doc_id for r in apart.collect()} == {d for d, (_, c) in expected.items() if d == c}
    cut = stages["repeats"](spark, apart, SF_DIR).cache()
    expected = brute_repeats([(r.doc_id, r.text) for r in apart.collect()], 100)
    found = {r.doc_id: len(r.text.encode()) for r in cut.collect()}
    assert all(0 <= n - gone - found.get(d, 0) <= 6 * spans for d, (n, gone, spans, _) in expected.items())
    packed = stages["packing"](spark, cut, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {d for d, n in found.items() if n}
    for frame in (good, lines, apart, cut):
        assert frame.columns == docs.columns


def test_pipeline_takes_odd_documents(spark):
    rows = [(1, None, "en", None, None), (None, "a b c", None, "s", 3), (2, "", "en", "s", 0), (3, "x " * 30000, "en", "s", 60000), (3, "x " * 30000, "en", "s", 60000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        assert docs.count() >= 0


def test_the_rest_works_without_the_text_operators(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/ebbtide", tmp_path / "ebbtide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) == len(registry.queries()) - len(QUERIES) - 1
