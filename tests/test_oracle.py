"""Every SQL-checkable catalogue query against DuckDB on the same parquet."""

import pytest

import __spark_entry__ as E
from fraudflow.plans import catalog
from fraudflow.sources import fixtures as fx
from pyspark.sql import functions as F
from tests.oracle_harness import compare, duck

from conftest import SF_SMALL

# the optional subpackage's queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
SAMPLED = {  # what must hold of results that no SQL can give
    "suspicious_receivers_approx": lambda df, s: df.count() > 0 == df.where("approx_distinct_senders_1d < 2").count(),
    "bloom_quality": lambda df, s: df.where("false_negatives = 0 AND fp_rate <= 0.02 AND bad_senders > 0").count() == 1,
    "sample_by": lambda df, s: 0.1 < df.count() / fx.txn_big(s, SF_SMALL).count() < 0.4,
    "random_split": lambda df, s: df.count() == fx.txn_big(s, SF_SMALL).count() > df.where("split = 'train'").count() > 0,
    "model_scored": lambda df, s: df.count() > 0 == df.where("fraud_probability NOT BETWEEN 0 AND 1").count(),
    # the smallest test split has no fraud, so no areas
    "model_metrics": lambda df, s: df.where("coalesce(areaUnderROC, 0) BETWEEN 0 AND 1 AND accuracy > 0.5").count() == 1,
    "ml_not_fraud": lambda df, s: df.where("fraud_probability >= 0.5 OR is_fraud_prediction = 1").count() == 0 < df.count(),
    "stream_pipeline_routes": lambda df, s: df.agg(F.sum("rows")).first()[0] == fx.txn(s, SF_SMALL).count(),
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_without_sql(spark, name):
    assert SAMPLED[name](QUERIES[name](spark, SF_SMALL), spark)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"window_start", "window_end", "transaction_type", "fraud_rate_2m"} <= set(df.columns)
