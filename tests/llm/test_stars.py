"""How members that their hub is not linked with are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderline.llm.shared import star_components


def test_small_buckets_need_no_items(spark):
    # Two pairs in one bucket of four: the hub is linked with one of them only.
    buckets = spark.createDataFrame([(1, n) for n in (1, 2, 3, 4)] + [(2, n) for n in (7, 8)], "bucket long, node long")
    linked = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long")
    asked = []

    def items(nodes):
        asked.append(nodes.count())
        return nodes.select("node", F.col("node").alias("item"))

    labels = star_components(buckets, lambda pairs: pairs.join(linked, ["a", "b"], "left_semi"), items, 80)
    assert {(r.node, r.component) for r in labels.collect()} >= {(2, 1), (4, 3)}
    assert not asked


def test_large_buckets_are_done_with_by_items(spark):
    # 40 members, more than are compared with each other: the hub is linked with none of them, 38 and 39 are equal sets.
    n = 40
    buckets = spark.createDataFrame([(1, k) for k in range(n)], "bucket long, node long")
    linked = spark.createDataFrame([(38, 39)], "a long, b long")

    def items(nodes):
        return nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).select("node", F.xxhash64(F.least("node", F.lit(38)), "i").alias("item"))

    labels = star_components(buckets, lambda pairs: pairs.join(linked, ["a", "b"], "left_semi"), items, 80)
    assert {(r.node, r.component) for r in labels.collect() if r.node != r.component} == {(39, 38)}
