"""The registered corpus queries: SQL where there is some, a plain version for the pipeline."""

import plain
import pytest

import corpus_pipeline
from compare import check, duck
from stationlab.llm.queries import QUERIES, SQL
from test_shingle_join import groups as similar_groups

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert check(spark, duck(SF), QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", ["op1_mix_sources", "op3_format_chat"])
def test_native_plans(spark, name):
    assert "Python" not in (plan := QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()) and "Arrow" not in plan


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    text = docs.first().text
    odd = spark.createDataFrame([(n + k, t, None, None, None) for k, t in enumerate([None, "", "123 !", text, text + " end"])], docs.schema)
    docs.union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = str(tmp_path)
    now = spark.read.parquet(f"{d}/documents.parquet")
    cols = now.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, d)
        before = sorted(((r.doc_id, r.text) for r in now.collect()), key=lambda x: x[0])
        out.write.parquet(f"{d}/{name}")
        now = spark.read.parquet(f"{d}/{name}")
        after = sorted((r.doc_id, r.text) for r in now.collect())
        if name != "mix":
            assert now.columns == cols
        if name == "language":
            assert {i for i, _ in before} - {i for i, _ in after} >= {n, n + 1, n + 2}
            assert len(after) >= 0.98 * n
        elif name == "near_duplicates":
            roots = similar_groups([t for _, t in before])
            assert after == [before[k] for k in sorted(set(roots))]
        elif name == "repeats":
            expect = [(i, t if len(k) == m else " ".join(k)) for (i, t), (_, m, k) in zip(before, plain.word_repeats(before), strict=True) if k]
            assert after == expect
        elif name == "benchmark":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
            assert after == [x for x, c in zip(before, plain.contamination(before, items), strict=True) if not c[5]]
        else:
            known = dict(before)
            assert all(known[i] == t for i, t in after)
            total = sum(len(plain.words(t)) for _, t in before)
            assert abs(sum(len(plain.words(t)) for _, t in after) - 1.5 * total) < 0.1 * total
