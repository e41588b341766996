"""Checksums of files of any size, taken by tasks."""

import hashlib
import os

import duckdb

from ebbtide.operators.integrity import _hasher, file_manifest


def test_paths_and_sizes(spark, tmp_path):
    (tmp_path / "in side").mkdir()
    held = {"small.bin": b"abc", "in side/large%20 é.bin": bytes(range(256)) * 400, "empty#?.txt": b"", "zip.gz": b"not zipped", "manifest.json": b"{}" * 999}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    found = {r.path: (r.bytes, r.sha256) for r in file_manifest(spark, str(tmp_path)).collect()}
    del held["manifest.json"]
    assert found == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in held.items()}


def test_a_file_beyond_what_spark_reads_as_one_value(spark, tmp_path):
    """300 MB, with a limit of 1000 bytes for values: nothing is read as one, and the driver opens no file."""
    path = tmp_path / "large.bin"
    with path.open("wb") as f:
        f.write(b"head")
        f.truncate(300_000_000)
        f.seek(0, os.SEEK_END)
        f.write(b"tail")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        (row,) = file_manifest(spark, f"file://{tmp_path}/").collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    with path.open("rb") as f:
        assert tuple(row) == ("large.bin", 300_000_004, hashlib.file_digest(f, "sha256").hexdigest())


def test_pieces_make_no_difference(tmp_path):
    import pyarrow as pa

    (tmp_path / "a").write_bytes(os.urandom(10_001))
    paths = pa.RecordBatch.from_pydict({"path": ["a"]})
    results = {b["sha256"][0].as_py() for piece in (1, 100, 10_001, 10**6) for b in _hasher(f"file://{tmp_path}", piece)([paths])}
    assert results == {hashlib.sha256((tmp_path / "a").read_bytes()).hexdigest()}


def test_equals_sql_over_files(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"d{i % 3}").mkdir(exist_ok=True)
        (tmp_path / f"d{i % 3}" / f"{i}.bin").write_bytes(os.urandom(i * 37))
    expected = duckdb.sql(f"SELECT replace(filename, '{tmp_path}/', ''), size, sha256(content) FROM read_blob('{tmp_path}/**')").fetchall()
    assert sorted(tuple(r) for r in file_manifest(spark, str(tmp_path)).collect()) == sorted(expected)


def test_an_empty_folder(spark, tmp_path):
    (tmp_path / "manifest.json").write_text("{}")
    assert file_manifest(spark, str(tmp_path)).collect() == []
