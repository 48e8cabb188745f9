import numpy as np
import pytest
from pyspark.sql import functions as F

from tillscope.operators import forest, txn_features
from tillscope.plans import jobs, views
from tillscope.sources import readers
from tillscope.streaming import scoring

SF = "/root/testdata/sf0.001"


def test_jobs_write_their_results(spark, tmp_path):
    out = jobs.run_all(views.transactions(spark, SF), views.purchases(spark, SF), views.sales_rows(spark, SF), str(tmp_path), k=3)
    figures = out["summary"].first()
    assert figures.segments_count == 3 and figures.fraud_flagged_transactions > 0 and figures.forecast_mape > 0 and 0 <= figures.detector_auc_roc <= 1
    for part in ("fraud/summary", "fraud/metrics", "segments/summary", "forecast/summary", "summary"):
        assert spark.read.json(str(tmp_path / part)).count() >= 1
    assert readers.load_csv(spark, str(tmp_path / "forecast/rows")).count() == 30
    assert readers.load_csv(spark, str(tmp_path / "fraud/flagged")).count() == figures.fraud_flagged_transactions
    segments = out["segmentation"]
    assert segments["campaigns"].count() == 3 and segments["selection"].count() == 0
    with pytest.raises(ValueError):
        jobs.forecast_job(views.sales_rows(spark, SF), "oracle")
    with pytest.raises(ValueError):
        jobs.fraud_job(views.sales_rows(spark, SF))


def test_unlabelled_transactions_and_renamed_columns(spark):
    t = views.transactions(spark, SF).drop("is_fraud").withColumnRenamed("customer_id", "client")
    out = jobs.fraud_job(t, {"customer_id": "client"}, trees=10)
    assert "metrics" not in out and out["scored"].count() == t.count()


def test_stream_equals_batch(spark, tmp_path):
    t = views.transactions(spark, SF)
    amounts = txn_features.fit_amounts(t)
    featured = scoring.row_features(t, amounts)
    _, model = forest.detect(featured, list(scoring.ROW_FEATURES), "transaction_id", trees=20)
    batch = {r.transaction_id: r.anomaly_score for r in scoring.score_transactions(t, model, amounts).collect()}
    source = str(tmp_path / "in")
    t.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(source)
    scoring.append_to(scoring.score_transactions(stream, model, amounts), str(tmp_path / "out"), str(tmp_path / "cp"), True).awaitTermination()
    got = {r.transaction_id: r.anomaly_score for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got.keys() == batch.keys() and np.allclose([got[k] for k in batch], list(batch.values()))
    totals = scoring.daily_totals(spark.readStream.schema(t.schema).parquet(source), "timestamp", ["amount"])
    scoring.append_to(totals, str(tmp_path / "days"), str(tmp_path / "cp2"), True).awaitTermination()
    final = {r.ds: r.amount for r in spark.read.parquet(str(tmp_path / "days")).collect()}
    expect = {r.d: r.a for r in t.groupBy(F.date_trunc("day", "timestamp").alias("d")).agg(F.sum("amount").alias("a")).collect()}
    assert final and all(np.isclose(expect[d], v) for d, v in final.items())


def test_workspace_removes_its_tables(spark):
    from tillscope.session import materialize, workspace

    with workspace(spark):
        held = materialize(spark.range(10).toDF("x"))
        assert held.count() == 10
    with pytest.raises(Exception):
        spark.read.parquet(held.inputFiles()[0]).count()


def test_fraud_job_writes_the_scored_rows_once(spark, monkeypatch):
    written = []
    for module in (jobs, jobs.forest):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, _f=plain: written.append(df.columns) or _f(df))
    out = jobs.fraud_job(views.transactions(spark, SF), trees=3)
    assert sum("raw_score" in c or "anomaly_score" in c for c in written) == 1
    assert out["scored"].count() == views.transactions(spark, SF).count()


def test_written_tables_are_zstd(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from tillscope import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    out = session.materialize(spark.createDataFrame([(1, "a"), (2, None)], "k long, v string"))
    files = list(tmp_path.glob("tables/*/*.parquet"))
    assert out.count() == 2 and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).num_row_groups} == {"ZSTD"}
