"""Model queries read every element of the vectors."""

import numpy as np
import pytest

import __spark_entry__
from featherline.operators import stats as T


@pytest.fixture(scope="module")
def vectors(spark, small):
    return np.array([r.embedding for r in spark.read.parquet(f"{small}/embeddings.parquet").select("embedding").collect()], float)


def test_pca_of_all_elements(spark, small, vectors):
    got = __spark_entry__.queries()["pca"](spark, small).collect()
    assert {r.feature for r in got} == {f"d{i}" for i in range(vectors.shape[1])}
    z = vectors - vectors.mean(0)
    e = np.linalg.eigvalsh(z.T @ z)[::-1]
    assert sorted({r.component: r.share for r in got}.values(), reverse=True) == pytest.approx((e / e.sum())[:3], abs=2e-6)


def test_ward_of_all_elements(spark, small, vectors):
    got = {r.feature: r.cluster for r in __spark_entry__.queries()["ward_features"](spark, small).collect()}
    want = T.ward_clusters(1 - np.abs(np.corrcoef(vectors.T)))
    pairs = {(got[f"d{i}"], int(c)) for i, c in enumerate(want)}
    assert len(got) == len(want) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
