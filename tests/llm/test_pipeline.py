"""The pipeline, stage by stage, on tables with nulls, odd texts, repeats and clashing names, and on empty ones."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture
def tables(spark, odd, tmp_path):
    clean = " ".join(f"word{i % 40} and then some" for i in range(60))
    planted = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    more = [(100 + i, f"{clean} {i} ends here number{i}.", "en", "c") for i in range(40)] + [(200 + i, f"you idiotful fool {i} number{i * 7} of {i}", "en", "c") for i in range(40)]
    more += [(300, f"Before. {planted.title()} after", "en", "c"), (301, clean + " x", None, "c"), (301, clean + " x", None, "c")]
    docs = odd.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string"), allowMissingColumns=True).withColumns({"_hash_": F.lit("h"), "_doc_": F.lit(1), "keys": F.lit(2)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, 0) for i in range(40)] + [(200 + i, 0, 1) for i in range(40)] + [(200, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, planted), (2, None), (3, "!")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    left = {}
    for name, f in pipeline.STAGES[:-1]:
        before, docs = docs, f(spark, docs, tables)
        had, kept = (Counter(map(tuple, x.collect())) for x in (before, docs))
        assert docs.columns == before.columns and not kept - had
        left[name] = [r[docs.columns.index("doc_id")] for r in kept.elements()]
    toxic = set(range(200, 240))
    assert not toxic & set(left["toxicity"]) and {301, 300, None, 1, 8} <= set(left["toxicity"]) and len(left["toxicity"]) == 11 + 40 + 3
    assert not {1, 2, 5} & set(left["language_id"])
    assert left["jaccard_join"].count(3) == 1 and 4 not in left["jaccard_join"] and left["jaccard_join"].count(301) <= 1
    assert 300 in left["jaccard_join"] and 300 not in left["decontamination"]
    pieces = pipeline.run(spark, tables).collect()
    assert {r.doc_id for r in pieces} == set(left["decontamination"])


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0
