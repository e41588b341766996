import hashlib
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import experiment, integrity, metrics, models, monitoring, prepare
from ebbtide.plans import audit, feature_build, score_batch, train, validate
from ebbtide.sources import io
from ebbtide.spec import CATEGORICAL_FEATURES, NUMERIC_FEATURES


def write(path, header, lines):
    path.write_text("\n".join([header, *lines]) + "\n")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """A small raw data folder; cancellations raise the churn rate."""
    at = tmp_path_factory.mktemp("raw")
    noise = random.Random(4)
    people = [f"u{i:03d}" for i in range(240)]
    cancels = {c: {p for p in people if noise.random() < 0.3} for c in ("201701", "201702")}
    for name, month in (("train.csv", "201701"), ("train_v2.csv", "201702")):
        write(at / name, "msno,is_churn", [
            f"{p},{int(noise.random() < (0.8 if p in cancels[month] else 0.1))}" for p in people
        ])
    head = "msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs"
    for name, months in (("user_logs.csv", ("201611", "201612", "201701")), ("user_logs_v2.csv", ("201702", "201703"))):
        write(at / name, head, [
            f"{p},{m}{d:02d},1,0,0,0,{d},2,{noise.choice([-5, 100, 90000, 3600])}"
            for p in [*people, "stranger"] for m in months for d in (1, 15)
        ])
    tx_head = ("msno,payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,is_auto_renew,"
               "transaction_date,membership_expire_date,is_cancel")
    lines = {
        m: [f"{p},41,30,149,149,1,{m}05,{n}10,{int(p in cancels[m])}" for p in people]
        for m, n in (("201701", "201702"), ("201702", "201703"))
    }
    write(at / "transactions.csv", tx_head, lines["201701"])
    write(at / "transactions_v2.csv", tx_head, lines["201701"] + lines["201702"])
    write(at / "members_v3.csv", "msno,city,bd,gender,registered_via,registration_init_time", [
        f"{p},{noise.randint(1, 4)},{noise.randint(0, 60)},{noise.choice(['male', 'female', ''])},"
        f"{noise.choice([3, 7, 9])},2015{noise.randint(1, 12):02d}01" for p in people
    ])
    return str(at)


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    feature_build.main(["--data-dir", raw, "--output-dir", out])
    return out


def test_build_from_raw_files(spark, built):
    snapshot = spark.read.parquet(f"{built}/snapshot_features")
    assert set(NUMERIC_FEATURES) | set(CATEGORICAL_FEATURES) <= set(snapshot.columns)
    assert {(r.cohort, r["count"]) for r in snapshot.groupBy("cohort").count().collect()} == {("train", 240), ("train_v2", 240)}
    early = snapshot.where("cohort = 'train'")
    assert early.agg(F.max("transactions_history")).first()[0] == 1
    assert early.where("anchor_expiry_date = '20170210'").count() == 240
    monthly = spark.read.parquet(f"{built}/transactions_monthly")
    assert monthly.count() == 480 and monthly.where("transaction_count > 1").count() == 0
    logs = spark.read.parquet(f"{built}/logs_monthly_clean")
    assert logs.where("msno = 'stranger'").count() == 0 and "total_secs" not in logs.columns
    assert "total_secs" in spark.read.parquet(f"{built}/logs_monthly").columns


def test_build_needs_all_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="members"):
        feature_build.main(["--data-dir", str(tmp_path), "--output-dir", str(tmp_path / "out")])


def test_audit_skips_missing_files(spark, raw, tmp_path):
    assert audit.audit(spark, raw, str(tmp_path / "audit")) == []
    inventory = spark.read.option("header", True).csv(str(tmp_path / "audit" / "inventory"))
    found = {r.source: int(r.rows) for r in inventory.collect()}
    assert found["members_v3.csv"] == 240 and found["transactions_v2.csv"] == 480
    empty = tmp_path / "empty"
    empty.mkdir()
    write(empty / "train.csv", "msno,is_churn", ["a,1"])
    assert len(audit.audit(spark, str(empty), str(tmp_path / "audit2"))) == 6


@pytest.fixture(scope="module")
def trained(spark, built, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("models"))
    metrics_table = train.train_and_evaluate(
        spark, f"{built}/snapshot_features", out, max_iter=5, repeats=2
    )
    return out, metrics_table.collect()


def test_models_find_the_signal(spark, trained):
    out, found = trained
    assert len(found) == 4
    for r in found:
        assert r.roc_auc > 0.65, r
        assert r.average_precision > r.churn_rate
    importance = spark.read.option("header", True).csv(f"{out}/permutation_importance").collect()
    assert len(importance) == 22
    best = max(importance, key=lambda r: float(r.average_precision_drop_mean))
    assert best.feature == "cancel_count_last3"
    queue_file = spark.read.option("header", True).csv(f"{out}/top_decile_outreach_queue")
    assert "is_churn" not in queue_file.columns and queue_file.count() == 24
    calibration = {r.score_type: float(r.brier_score) for r in spark.read.option("header", True).csv(f"{out}/calibration_metrics").collect()}
    assert calibration["Isotonic calibrated"] < calibration["Raw model score"]


def test_stored_model_gives_the_same_scores(spark, built, trained):
    out, _ = trained
    late = spark.read.parquet(f"{built}/snapshot_features").where("cohort = 'train_v2'")
    scores = spark.read.parquet(f"{out}/scores").where("period = 'Later cohort'")
    for name, folder in (("Boosted trees", "boosted_trees"), ("Logistic baseline", "logistic_baseline")):
        again = models.ChurnModel.load(spark, f"{out}/{folder}").score(late)
        first = scores.where(F.col("model") == name)
        gap = again.select("msno", F.col("risk_score").alias("b")).join(first, "msno").agg(F.max(F.abs(F.col("b") - F.col("risk_score"))))
        assert gap.first()[0] < 1e-12


def test_scoring_job(spark, built, trained, tmp_path):
    out, _ = trained
    target = str(tmp_path / "batch")
    score_batch.main([
        "--input", f"{built}/snapshot_features", "--model", f"{out}/boosted_trees", "--contact-share", "0.25",
        "--output-dir", target,
    ])
    scored = spark.read.parquet(f"{target}/customer_risk_scores")
    assert scored.count() == 240 and scored.where("risk_band = 'High'").count() == 24
    outreach = spark.read.option("header", True).csv(f"{target}/outreach_queue")
    assert outreach.count() == 60 and "is_churn" not in outreach.columns
    with pytest.raises(ValueError, match="duplicate"):
        score_batch.score_batch(spark, f"{built}/snapshot_features", f"{out}/boosted_trees", target, cohort="none")
    with pytest.raises(ValueError, match="no rows"):
        score_batch.score_batch(spark, f"{built}/snapshot_features", f"{out}/boosted_trees", target, cohort="x")
    with pytest.raises(ValueError, match="share"):
        score_batch.score_batch(spark, f"{built}/snapshot_features", f"{out}/boosted_trees", target, share=0)


def test_validation_job(spark, built, trained, tmp_path):
    out, _ = trained
    batch = str(tmp_path / "batch")
    score_batch.score_batch(spark, f"{built}/snapshot_features", f"{out}/boosted_trees", batch)
    assert validate.validate(spark, str(tmp_path / "good"), built, batch) == []
    assert len(list((tmp_path / "good").iterdir())) == 13
    bands = spark.read.option("header", True).csv(str(tmp_path / "good" / "churn_by_band")).collect()
    assert sum(int(r.customers) for r in bands) == 240
    bad = str(tmp_path / "bad")
    scores = spark.read.parquet(f"{batch}/customer_risk_scores")
    broken = scores.unionByName(scores.limit(1)).withColumn("risk_score", F.when(F.col("risk_rank") > 1, F.col("risk_score")))
    io.write_table(broken, f"{bad}/customer_risk_scores")
    spark.createDataFrame([("u1", 1)], "msno string, is_churn int").write.option("header", True).csv(f"{bad}/outreach_queue")
    assert set(validate.validate(spark, str(tmp_path / "found"), batch=bad)) == {"scores: repeated", "scores: missing", "queue: label"}
    with pytest.raises(SystemExit):
        validate.main(["--batch", bad, "--output-dir", str(tmp_path / "again")])


def test_validation_of_files(spark, tmp_path):
    at = tmp_path / "files"
    at.mkdir()
    (at / "model.bin").write_bytes(b"one")
    lines = [f'{{"path": "model.bin", "sha256": "{hashlib.sha256(b"one").hexdigest()}"}}']
    (tmp_path / "list.json").write_text("\n".join(lines))
    args = {"folder": str(at), "manifest": str(tmp_path / "list.json"), "required": ["model.bin"]}
    assert validate.validate(spark, str(tmp_path / "a"), **args) == []
    (at / "model.bin").write_bytes(b"two")
    assert validate.validate(spark, str(tmp_path / "b"), **args) == ["files: failed"]


def test_inventory_of_files_without_rows_and_of_late_blocks(spark, tmp_path):
    write(tmp_path / "a.csv", "k,v", [f"a{i},{i}" for i in range(5)])
    (tmp_path / "b.csv").write_text("k,v\n")
    found = {r.file.rsplit("/", 1)[-1]: r for r in io.source_inventory(spark, {"s": str(tmp_path / "*.csv")}).collect()}
    assert (found["a.csv"].rows, found["b.csv"].rows) == (5, 0)
    one = str(tmp_path / "one.parquet")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1).write.parquet(one)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        big = io.source_inventory(spark, {"s": one}, fmt="parquet").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(big) == 1 and big[0].rows == 20_000 and len(big[0].first_rows) == 3
    assert '"id":0,' in big[0].first_rows[0]


def test_audit_reports_a_missing_date_column(spark, raw, tmp_path):
    at = tmp_path / "raw"
    shutil.copytree(raw, at)
    write(at / "user_logs_v2.csv", "msno,total_secs", ["u1,5"])
    assert audit.audit(spark, str(at), str(tmp_path / "out")) == ["user_logs_v2.csv: date"]


def test_unseen_levels_and_missing_numbers_are_scored(spark, built, trained):
    out, _ = trained
    late = spark.read.parquet(f"{built}/snapshot_features").where("cohort = 'train_v2'")
    odd = late.withColumns({"city": F.lit(999), "gender": F.lit("new"), "age": F.lit(None).cast("int"),
                            "listening_secs_last3": F.lit(float("inf"))})
    for folder in ("boosted_trees", "logistic_baseline"):
        scored = models.ChurnModel.load(spark, f"{out}/{folder}").score(odd)
        assert scored.where("risk_score between 0 and 1").count() == 240


def test_isotonic_is_monotone_and_clipped(spark):
    noise = random.Random(1)
    data = [(f"c{i}", int(noise.random() < i / 300), (i // 3) / 100) for i in range(300)]
    df = spark.createDataFrame(data, "msno string, is_churn int, risk_score double")
    model = models.fit_isotonic(df)
    probe = spark.createDataFrame([(x / 50 - 0.5,) for x in range(100)], "risk_score double")
    found = [r.calibrated_score for r in models.calibrate(model, probe).orderBy("risk_score").collect()]
    assert found == sorted(found) and min(found) >= 1e-6 and max(found) <= 1 - 1e-6
    assert found[0] == found[10]


def test_manifest_round_trip_and_failures(spark, tmp_path):
    files = {"a.txt": b"one", "sub/b.txt": b"two", "manifest.json": b"{}"}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = {r.path: (r.bytes, r.sha256) for r in integrity.file_manifest(spark, str(tmp_path)).collect()}
    assert found == {n: (3, hashlib.sha256(files[n]).hexdigest()) for n in ("a.txt", "sub/b.txt")}
    actual = integrity.file_manifest(spark, str(tmp_path))
    assert integrity.verify_manifest(actual, actual, required=["a.txt"]).count() == 0
    expected = spark.createDataFrame([("a.txt", "bad"), ("gone", "x")], "path string, sha256 string")
    failures = integrity.verify_manifest(actual, expected, required=["model"], forbidden=["B.TXT", "secret"])
    assert {tuple(r) for r in failures.collect()} == {
        ("checksum mismatch", "a.txt"), ("missing file", "gone"), ("required file missing", "model"),
        ("forbidden file present", "B.TXT"),
    }


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 0, None)], "msno string, IS_CHURN int, month string")
    io.write_table(df, str(tmp_path / "t"), partition_by=["month"])
    assert any("zstd" in p.name for p in (tmp_path / "t").rglob("*.parquet"))
    written = io.write_report(df, str(tmp_path / "r"))
    assert written.columns == ["msno", "month"]
    back = io.read_raw(spark, str(tmp_path / "r"), ["month", "msno"])
    assert back.dtypes == [("month", "string"), ("msno", "string")] and back.count() == 2
    paths = {"here": str(tmp_path / "r"), "gone": str(tmp_path / "nope*.csv")}
    assert io.available(spark, paths, "skip") == ({"here": paths["here"]}, ["gone"])
    with pytest.raises(FileNotFoundError):
        io.available(spark, paths)


def test_inventory_shows_the_first_rows_of_each_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        write(tmp_path / name, "k,v", [f"{name}{i},{i}" for i in range(10)])
    found = io.source_inventory(spark, {"s": str(tmp_path / "*.csv")}).orderBy("file").collect()
    assert [(r.rows, r.columns) for r in found] == [(10, "k,v")] * 2
    assert found[0].bytes == (tmp_path / "a.csv").stat().st_size
    assert found[1].first_rows == ['{"k":"b.csv0","v":"0"}', '{"k":"b.csv1","v":"1"}', '{"k":"b.csv2","v":"2"}']


def test_arms_are_even_and_stable(spark, rows):
    people = spark.createDataFrame([(f"c{i}", "renewal" if i % 3 else "other") for i in range(101)], "msno string, route string")
    first = experiment.assign_arms(people)
    for r in first.groupBy("route").pivot("arm", ["treatment", "control"]).count().collect():
        assert abs(r.treatment - r.control) <= 1
    moved = people.withColumn("route", F.lit("cancellation")).unionByName(
        spark.createDataFrame([("new1", "renewal"), ("new2", "renewal")], "msno string, route string")
    )
    again = experiment.assign_arms(moved, previous=first.select("msno", "arm"))
    assert again.count() == 103
    assert rows(again.where("msno not like 'new%'"), "msno", "arm") == rows(first, "msno", "arm")


def test_drift_is_zero_for_equal_data_and_counts_missing(spark):
    df = spark.createDataFrame([(float(i), None if i % 2 else 1.0) for i in range(100)], "a double, b double")
    same = {r.feature: r.psi for r in monitoring.drift(df, df, ["a", "b"]).collect()}
    assert same["a"] == pytest.approx(0) and same["b"] == pytest.approx(0)
    moved = monitoring.drift(df.withColumn("a", F.col("a") + 50).withColumn("b", F.lit(1.0)), df, ["a", "b"])
    assert all(r.psi > 0.25 for r in moved.collect())


def test_a_collapsed_decile_raises_an_alert(spark):
    """A decile that shrinks, goes or comes is told; the first run and steady ones are not."""
    sizes = {"r1": [10] * 10, "r2": [20] * 10, "r3": [20] * 9 + [0], "r4": [22] * 9, "r5": [22] * 8 + [2], "r6": [20] * 8 + [2, 3]}
    data = [(run, f"{run}-{d}-{i}", d) for run, own in sizes.items() for d, n in enumerate(own, 1) for i in range(n)]
    batches = spark.createDataFrame(data, "run string, msno string, risk_decile int").withColumn("day", F.lit("2017-01-01").cast("date"))
    runs = monitoring.run_metrics(batches, "run", "msno", "day")
    found = monitoring.control_limits(runs, deciles=monitoring.decile_counts(batches, "run"))
    assert {r.run_id: r.decile_alert for r in found.collect()} == {"r1": False, "r2": False, "r3": True, "r4": False, "r5": True, "r6": True}
    assert "decile_alert" not in monitoring.control_limits(runs).columns
