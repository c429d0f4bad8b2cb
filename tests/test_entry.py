"""The driver contract, and queries against their oracle SQL at the smallest scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle_db

FOLDER = "/root/testdata/sf0.001"
QUICK = (
    "driver_features", "driver_features_ext", "constructor_features", "assemble_regression", "assemble_classification",
    "scan_csv_nulls", "hist_last5", "hist_season_rate", "hist_team_events", "advanced_features", "impute_median",
    "impute_group_max_plus1", "target_encode_sigmoid", "label_encode", "scale_robust", "fold_ids_stratified",
    "roc_auc", "average_precision", "classification_report", "describe_numeric", "quality_checks", "knn_join",
    "cluster_distance_outlier", "davies_bouldin", "silhouette_squared", "score_batch",
)
NAMES = sorted(queries()) if os.environ.get("PACEFRAME_FULL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def db():
    return oracle_db(FOLDER)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_is_stable(spark):
    a, b = entry(spark), entry(spark)
    assert a.schema == b.schema and a.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    result = compare(spark, db, FOLDER, name, queries()[name], oracle_sql().get(name))
    assert "FAIL" not in result, result
