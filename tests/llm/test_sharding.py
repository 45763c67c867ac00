from collections import Counter

import pytest
from pyspark.sql import functions as F

from strutwise.llm.sharding import domain, op8_feistel_shards, permuted, sharded


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 12_345])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), n, 3)).collect()]
    assert sorted(got) == list(range(n))
    a, b = domain(n)
    assert a * b >= n and a * b - n < a + b


def test_shuffles_and_depends_on_the_seed(spark):
    one, two = ([r[0] for r in spark.range(1000).select(permuted(F.col("id"), 1000, s)).collect()] for s in (1, 2))
    assert one != two and sum(abs(a - i) for i, a in enumerate(one)) > 200_000


def test_counts_and_slots(docs, rows):
    got = sharded(docs.select("doc_id", "text"), [F.col("doc_id"), F.col("text")], 5).collect()
    count = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))


def test_reruns_agree_and_columns_clash(docs, clashing):
    order = [F.col("doc_id"), F.col("text")]
    a = {(r.doc_id, r.text, r.shard, r.slot) for r in sharded(docs, order, 4).collect()}
    b = {(r.doc_id, r.text, r.shard, r.slot) for r in sharded(clashing.repartition(5), order, 4).collect()}
    assert a == b


def test_empty(none):
    assert sharded(none, [F.col("doc_id")], 4).count() == 0


def test_query(spark, sf):
    got = op8_feistel_shards(spark, sf)
    assert got.agg(F.max("shard"), F.count_distinct("doc_id") == F.count("*")).first() == (15, True)


def test_main_path_has_no_python(spark, sf):
    plan = op8_feistel_shards(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
