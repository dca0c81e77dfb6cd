"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from suite import ORACLE, QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLE[name], SF_DIR) is None


# Queries without SQL: what must hold for their rows.
CHECKS = {
    "srt_sample": "sampled > 0",
    "prf_columns_approx": "n >= nulls AND (n < 50 OR distinct <= n * 1.2)",
    "ml_forecast": "viajes_predichos >= 0 AND abs(error_absoluto - abs(viajes_reales - viajes_predichos)) < 1e-9",
    "ml_segments": "cluster_id BETWEEN 0 AND 3 AND silhouette_modelo BETWEEN -1 AND 1",
    "ml_classes": "demanda_predicha IN ('Baja', 'Media', 'Alta') AND probabilidad_predicha BETWEEN 0.3 AND 1 "
    "AND prediccion_correcta = (clase_demanda_id = clase_predicha_id)",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    total, good = rows.count(), rows.where(CHECKS[name]).count()
    assert 0 < total == good
