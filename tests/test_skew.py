"""One key holds a third of all rows: joins must split its partition, aggregates must combine it early."""

import re

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import history, joins, relational

ROWS = 120_000
HOT = ROWS // 3


@pytest.fixture
def shuffled(spark):
    """Joins that shuffle, and partitions that count as skewed at test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def rows(spark):
    ids = spark.range(0, ROWS, 1, 8)
    own = F.sha2(F.col("id").cast("string"), 256)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(own).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        F.lit(1).alias("one"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_anti_join_with_history(rows, shuffled):
    known = rows.filter("k <> 'hot'").select("k", F.lit(1).alias("x"))
    fresh = joins.not_in_history(rows, known, ["k"])
    assert fresh.count() == HOT
    assert "skew=true" in final_plan(fresh)


def test_order_total(rows, shuffled):
    total = relational.order_total(rows, "k", F.col("one"), "total")
    assert total.groupBy("total").count().orderBy("total").collect() == [(1, ROWS - HOT), (HOT, HOT)]
    assert "skew=true" in final_plan(total)


def test_lookup(rows, shuffled):
    items = rows.filter("k <> 'hot'").select(F.col("k").alias("Barcode"), *[F.lit("x").alias(c) for c in joins.ITEM_COLUMNS])
    items = items.unionByName(items.limit(1).withColumn("Barcode", F.lit("hot")))
    joined = joins.with_item(rows.withColumnRenamed("k", "Barcode"), items)
    assert joined.filter("Style = 'x'").count() == ROWS
    assert "skew=true" in final_plan(joined)


@pytest.fixture
def plain(spark):
    """Shuffled joins in a session that does not split hot keys."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def largest_task(df):
    # With a column of the item, or the join would be left out.
    tasks = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("Style").alias("style"))
    return tasks.agg(F.max("n"), F.max("style")).first()[0]


def test_rows_without_barcode(rows, plain):
    """A third of all lines without a barcode is no hot key: the rows are spread."""
    lines = rows.select(F.nullif(F.col("k"), F.lit("hot")).alias("Barcode"), "payload")
    items = rows.filter("k <> 'hot'").select(F.col("k").alias("Barcode"), *[F.lit("x").alias(c) for c in joins.ITEM_COLUMNS])
    joined = joins.with_item(lines, items)
    assert joined.columns == ["Barcode", "payload", *joins.ITEM_COLUMNS]
    assert joined.filter("Style is null AND Barcode is null").count() == HOT
    assert largest_task(joined) < 1.3 * ROWS / 16


def test_hot_barcode_with_salts(rows, plain):
    lines = rows.withColumnRenamed("k", "Barcode")
    items = rows.select(F.col("k").alias("Barcode"), *[F.lit("x").alias(c) for c in joins.ITEM_COLUMNS]).dropDuplicates(["Barcode"])
    salted = joins.with_item(lines, items, salts=32)
    assert salted.filter("Style = 'x'").count() == ROWS
    assert largest_task(salted) < ROWS / 4 < HOT < largest_task(joins.with_item(lines, items))


def test_current_versions(spark, rows, shuffled):
    stamp = F.timestamp_micros(F.when(F.col("k") == "hot", F.monotonically_increasing_id()).otherwise(F.lit(5).cast("long")))
    table = rows.withColumn(history.STAMP, stamp).withColumn(history.LOAD, F.lit(1).cast("long"))
    current = history.current(table, ["k"])
    assert current.groupBy("k").count().filter("count > 1").count() == 0
    assert current.count() == ROWS - HOT + 1
    assert "skew=true" in final_plan(current)


def test_cancel_match(rows, shuffled):
    """Many items in one order: the key has the line number in it, so no partition is hot."""
    numbered = rows.select(
        F.lit("s").alias("eCom_Store_ID"),
        F.col("k").alias("Transaction_Nbr"),
        F.conv(F.substring("payload", 1, 7), 16, 10).alias("ORDER_D_NO"),
        "payload",
    )
    lines = numbered.withColumn("Item_Seq_Number", F.col("ORDER_D_NO").cast("int")).drop("ORDER_D_NO")
    matched = joins.cancel_match(numbered, lines.withColumnRenamed("payload", "other"), ["other"])
    assert matched.filter("payload = other").count() == ROWS


@pytest.mark.parametrize("aggregate", ["one_per_key", "total"])
def test_hot_groups_are_combined_before_the_shuffle(rows, aggregate):
    if aggregate == "one_per_key":
        df = history.one_per_key(rows.select("k", "one"), ["k"])
    else:
        df = relational.order_total(rows, "k", F.col("one"), "total").select("total")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"partial_(max|sum)", plan)
