import pytest

import __spark_entry__ as contract
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
CHECKED = [
    "rfm", "rfm_segments", "segment_profile", "purchase_intervals", "spending_trend", "txn_amount_features", "txn_velocity", "txn_window_stats", "txn_percentiles", "baselines",
    "clean_orders", "outliers_remove_iqr", "scale_robust", "label_encode", "validation_report", "text_summary", "ks_drift", "roc", "threshold_sweep", "best_business_threshold",
    "dense_series", "lags", "rolling", "forecast_metrics", "residuals", "kruskal", "overlap", "migration", "personas", "ensemble_vote_soft", "csv_round_trip", "impute_nearest",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None


def test_entry_and_names(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries()) and len(contract.queries()) > 100
