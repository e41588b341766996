"""The usage store against full builds of the same files."""

import os

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import incremental, rollup
from ebbtide.operators.incremental import UsageStore
from ebbtide.plans import add_logs
from ebbtide.sources import io

HEADER = "msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs"


def write(path, rows):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([HEADER, *rows]) + "\n")


def lines(customers, month, seed):
    odd = ["-5", "NaN", "", "Infinity", "90000"]
    return [f"u{c},{month}{1 + (c * 7 + seed) % 28:02d},{c % 3},1,x,0,{seed},2,{odd[c % 5] if c % 4 == 0 else c * 10.5}" for c in customers] + [f",{month}01,1,1,1,1,1,1,1", "u1,,1,1,1,1,1,1,1"]


@pytest.fixture
def files(tmp_path):
    at = tmp_path / "raw"
    write(at / "a.csv", lines(range(1, 40), "201701", 1) + lines(range(5), "201702", 2))
    write(at / "b.csv", lines(range(20, 60), "201702", 3))
    write(at / "c [d]%20.csv", lines(range(10), "201703", 4) + ["u3,20,1,1,1,1,1,1,5"])
    return at


def built(spark, at):
    return rollup.monthly_clean_usage(io.read_raw(spark, str(at / "*.csv")), keep_raw=True)


def same(rows, store, full):
    columns = full.columns
    return rows(store.table(), *columns) == rows(full, *columns)


def test_adding_equals_a_full_build(spark, rows, files, tmp_path):
    store = UsageStore(spark, str(tmp_path / "store"))
    assert store.table().count() == 0
    store.add([str(files / "a.csv")])
    store.add([str(files / "b.csv"), str(files / "c*.csv")])
    assert same(rows, store, built(spark, files)) and store.ledger().count() == 3


def test_files_added_twice_change_nothing(spark, rows, files, tmp_path):
    store = UsageStore(spark, str(tmp_path / "store"))
    store.add([str(files)])
    before = {p: os.stat(p).st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    store.add([str(files), str(files / "a.csv")])
    assert {p: os.stat(p).st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")} == before
    assert same(rows, store, built(spark, files))


def test_only_touched_months_are_written(spark, files, tmp_path):
    store = UsageStore(spark, str(tmp_path / "store"))
    store.add([str(files / "a.csv")])

    def parts():
        return {p.parent.name: p.name for p in (tmp_path / "store" / "usage").rglob("*.parquet")}

    before = parts()
    store.add([str(files / "b.csv")])
    assert set(before) == {"_folder=p201701", "_folder=p201702"}
    assert parts()["_folder=p201701"] == before["_folder=p201701"] and parts()["_folder=p201702"] != before["_folder=p201702"]


def test_a_changed_file_replaces_what_it_said(spark, rows, files, tmp_path):
    store = UsageStore(spark, str(tmp_path / "store"))
    store.add([str(files)])
    write(files / "c [d]%20.csv", lines(range(30), "201702", 9))
    store.add([str(files)])
    assert same(rows, store, built(spark, files)) and store.table().where("month = '201703'").count() == 0
    assert store.ledger().count() == 4 and store.current().count() == 3


def test_a_job_that_died_is_finished_by_the_next(spark, rows, files, tmp_path, monkeypatch):
    """Sums without a ledger entry don't count; an entry whose months were not written is made good."""
    store = UsageStore(spark, str(tmp_path / "store"))
    store.add([str(files / "a.csv")])

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(UsageStore, "finish", die)
    with pytest.raises(RuntimeError):
        store.add([str(files / "b.csv")])
    with monkeypatch.context() as m:
        m.setattr(incremental.F, "current_timestamp", die)
        with pytest.raises(RuntimeError):
            store.add([str(files / "c*.csv")])
    monkeypatch.undo()
    assert store.partials().select("batch").distinct().count() == 3 and store.ledger().count() == 2
    store.finish()
    assert store.table().agg(F.sum("log_rows")).first()[0] == 44 + 40
    store.add([str(files)])
    assert same(rows, store, built(spark, files))


def test_job(spark, rows, files, tmp_path):
    out = str(tmp_path / "monthly")
    add_logs.main(["--store", str(tmp_path / "store"), "--files", str(files / "a.csv"), str(files / "b.csv")])
    add_logs.main(["--store", str(tmp_path / "store"), "--files", str(files), "--output", out])
    full = built(spark, files).drop("total_secs")
    assert rows(spark.read.parquet(out), *full.columns) == rows(full)


def test_a_period_is_written_by_few_tasks(spark, rows, tmp_path):
    """However many tasks sum up the files, a small period has one file of partial sums per batch and one of usage."""
    for i in range(12):
        write(tmp_path / "raw" / f"f{i}.csv", lines(range(i * 30, i * 30 + 30), "201701", i) + lines(range(30), "201702", i))
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = UsageStore(spark, str(tmp_path / "store"))
        store.add([str(tmp_path / "raw")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    for name in ("partials", "usage"):
        found = [p.parent for p in (tmp_path / "store" / name).rglob("*.parquet")]
        assert len(found) == len(set(found)) == 2
    assert same(rows, store, built_all(spark, tmp_path / "raw"))


def built_all(spark, at):
    return rollup.monthly_clean_usage(io.read_raw(spark, str(at)), keep_raw=True)
