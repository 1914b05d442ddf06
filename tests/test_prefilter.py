"""Rows of strangers are left out before the shuffle; the join settles the rest."""

import pytest
from pyspark.sql import functions as F

from tenure.operators import prefilter


@pytest.fixture(scope="module")
def tables(spark):
    keys = spark.range(500).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    rows = spark.range(20_000).select(F.when(F.col("id") % 97 > 0, F.concat(F.lit("C"), "id")).alias("customer_id"), "id")
    return keys, rows


def test_few_strangers_pass_and_no_key_is_lost(tables):
    keys, rows = tables
    passed = prefilter.perhaps_in(rows, "customer_id", prefilter.key_filter(keys, "customer_id"))
    ids = {r["id"] for r in passed.collect()}
    known = {i for i in range(500) if i % 97}
    assert known <= ids and len(ids - known) < 0.02 * 20_000


def test_false_positives_are_settled_by_the_join(tables):
    keys, rows = tables
    # One word for all keys: nearly everything passes.
    full = prefilter.key_filter(keys, "customer_id")._replace(size=1)
    words = keys.groupBy(F.lit(0).cast("long").alias("_word")).agg(F.bit_or(prefilter._bits(F.col("customer_id"))).alias("_bits"))
    crowded = full._replace(words=words)
    assert prefilter.perhaps_in(rows, "customer_id", crowded).count() > 15_000
    for known in (None, crowded, full._replace(bytes=1 << 40)):
        found = prefilter.known_rows(rows, keys, "customer_id", known)
        assert {r["id"] for r in found.collect()} == {i for i in range(500) if i % 97}
        others = prefilter.unknown_rows(rows, keys, "customer_id", known)
        assert others.count() == 20_000 - found.count() and others.where("customer_id IS NULL").count() == 207


def test_fewer_rows_are_shuffled(spark, tables):
    keys, rows = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:

        def shuffled(df):
            df.collect()
            counts = []

            def walk(node):
                name = node.nodeName()
                written = node.metrics().get("shuffleRecordsWritten")
                if written.isDefined():
                    counts.append(written.get().value())
                if name.endswith("QueryStage"):
                    walk(node.plan())
                if name == "AdaptiveSparkPlan":
                    walk(node.executedPlan())
                for i in range(node.children().size()):
                    walk(node.children().apply(i))

            walk(df._jdf.queryExecution().executedPlan())
            return max(counts)

        plain = shuffled(rows.join(keys, "customer_id", "left_semi"))
        filtered = shuffled(prefilter.known_rows(rows, keys, "customer_id"))
        assert plain > 19_000 and filtered < 1_500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_keys_and_no_rows(spark, tables):
    keys, rows = tables
    assert prefilter.known_rows(rows, keys.limit(0), "customer_id").count() == 0
    assert prefilter.known_rows(rows.limit(0), keys, "customer_id").count() == 0
    assert prefilter.unknown_rows(rows.limit(3), keys.limit(0), "customer_id").count() == 3
