"""Plans and operators under skew: hot keys, ties, size checks, pruning."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS
from lakemart.operators import joins
from lakemart.operators.dedupe import latest_per_key
from lakemart.operators.ranking import global_row_number, top_n_per_group
from lakemart.plans import gold, refresh, silver
from lakemart.sources import files
from tests.compare import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture()
def skewed(spark):
    """A third of the rows holds one key, a tenth has none, the others are spread thin."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 2500)
    return spark.range(30_000).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture()
def dimension(spark):
    return spark.range(0, 2000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def test_heavy_keys_are_few(spark, skewed):
    found = {r["k"]: r["_salts"] for r in joins.heavy_keys(skewed, "k").collect()}
    total, hot = skewed.where("k is not null").count(), skewed.where("k = 7").count()
    assert found[7] == -(-hot * joins.PARTS // total)
    assert sum(found.values()) < 2 * joins.PARTS
    even = spark.range(20_000).select(F.col("id").alias("k"))
    assert joins.heavy_keys(even, "k").count() == 0


def test_hot_key_is_split_evenly(skewed, no_broadcast, dimension):
    """The largest part a task could be handed, by join key and salt, against the largest key."""
    salts = F.broadcast(joins.heavy_keys(skewed, "k"))
    parts = (
        skewed.join(salts, "k", "left")
        .groupBy("k", F.pmod(F.xxhash64("v"), F.coalesce("_salts", F.lit(joins.PARTS))))
        .count()
    )
    assert parts.agg(F.max("count")).first()[0] <= 16


def exchanges(df):
    return plan(df).count("Exchange")


def test_small_dimension_is_broadcast(spark, skewed):
    small = spark.sql("select id k, 'n' name from range(9)")
    assert "BroadcastHashJoin" in plan(joins.lookup_join(skewed, small, "k"))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_look_up_is_the_plain_join_at_every_size(spark, skewed, dimension, threshold):
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, threshold)
    try:
        found, expected = joins.lookup_join(skewed, dimension, "k"), skewed.join(dimension, "k", "left")
        assert found.columns == expected.columns and exchanges(found) == exchanges(expected)
        assert rows(found, "k", "v", "name") == rows(expected, "k", "v", "name")
        keys_only = skewed.select("k")
        assert rows(joins.lookup_join(keys_only, dimension, "k"), "k", "name") == rows(expected, "k", "name")
        twice = dimension.unionByName(dimension)
        assert rows(joins.known_rows(skewed, twice, "k"), "k", "v") == rows(
            joins.known_rows(skewed, dimension, "k"), "k", "v"
        )
    finally:
        spark.conf.set(name, before)


def test_salted_look_up_is_right(spark, skewed, dimension, no_broadcast):
    heavy = joins.heavy_keys(skewed, "k")
    found = joins.salted_lookup_join(skewed, dimension, "k", heavy)
    assert re.search(r"hashpartitioning\(k#\w+, _salt", plan(found))
    expected = skewed.join(dimension, "k", "left")
    assert found.columns == expected.columns
    assert rows(found, "k", "v", "name") == rows(expected, "k", "v", "name")
    spread = found.where("k = 7")
    assert spread.count() == skewed.where("k = 7").count() >= 10_000
    keys_only = joins.salted_lookup_join(skewed.select("k"), dimension, "k", heavy)
    assert rows(keys_only, "k", "name") == rows(expected, "k", "name")


def test_semi_and_anti_joins_of_a_hot_key(skewed, dimension, no_broadcast):
    known = joins.known_rows(skewed, dimension, "k")
    unknown = joins.unknown_rows(skewed, dimension, "k")
    assert rows(known, "k", "v") == rows(skewed.join(dimension, "k", "left_semi"), "k", "v")
    assert rows(unknown, "k", "v") == rows(skewed.join(dimension, "k", "left_anti"), "k", "v")


def test_dedupe_keeps_one_row_per_key_and_task_before_the_shuffle(skewed):
    newest = latest_per_key(skewed, "k", "v")
    text = plan(newest)
    partial = text.index("Partial")
    assert text.index("Exchange hashpartitioning(k") < partial
    assert rows(newest, "k", "v") == rows(skewed.groupBy("k").agg(F.max("v").alias("v")), "k", "v")


def test_top_n_of_a_hot_group(skewed):
    found = top_n_per_group(skewed, ["k"], [F.desc("v")], 3, "place")
    assert re.search(r"WindowGroupLimit .* row_number\(\), 3, Partial", plan(found))
    window = Window.partitionBy("k").orderBy(F.desc("v"))
    expected = skewed.withColumn("place", F.row_number().over(window)).where("place <= 3")
    assert rows(found, "k", "v", "place") == rows(expected, "k", "v", "place")


@pytest.mark.parametrize("tied", [0, 2, 10])
def test_global_rank_equals_the_plain_window(spark, tied):
    """With ``tied`` = 10 all rows share the first sort column."""
    value = F.when(F.col("id") % 10 < tied, 0).otherwise(F.hash("id"))
    df = spark.range(20_000).repartition(6).select("id", value.alias("value"), F.rand(3).alias("other"))
    order = [F.desc("value"), F.asc("id")]
    found = global_row_number(df.drop("other"), order, "place")
    expected = df.drop("other").withColumn("place", F.row_number().over(Window.orderBy(*order)))
    assert found.select("id", "place").exceptAll(expected.select("id", "place")).count() == 0
    assert found.count() == 20_000


def test_global_rank_of_nothing(spark):
    assert global_row_number(spark.range(0).toDF("a"), [F.asc("a")]).count() == 0


def test_global_rank_sorts_in_many_partitions(spark):
    df = spark.range(20_000).select("id", F.hash("id").alias("value"))
    text = plan(df.orderBy(F.desc("value"), "id").withColumn("place", F.monotonically_increasing_id()))
    assert "rangepartitioning" in text and "SinglePartition" not in text


@pytest.fixture(scope="module")
def stored_silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("silver"))
    orders = spark.sql(
        "select cast(id as string) order_id, cast(id % 50 as string) customer_id, 'x' order_status, "
        "date_add(date'2020-01-01', cast(id % 20 as int)) order_purchase_date, 1 delivery_delay_days from range(1000)"
    )
    items = spark.sql(
        "select cast(id % 1000 as string) order_id, concat(id, '_1') order_item_key, cast(id % 30 as string) product_id, "
        "'s' seller_id, cast(id as decimal(12,2)) price, cast(1 as decimal(12,2)) freight_value, 'long text' note "
        "from range(3000)"
    )
    payments = spark.sql(
        "select cast(id as string) order_id, concat(id, '_1') payment_key, cast(id as decimal(12,2)) payment_value, "
        "'t' payment_type from range(1000)"
    )
    files.write_parquet(orders, f"{root}/orders", partition="order_purchase_date")
    files.write_parquet(items, f"{root}/items")
    files.write_parquet(payments, f"{root}/payments")
    return [files.read_parquet(spark, f"{root}/{name}") for name in ("orders", "items", "payments")]


def test_marts_read_only_their_columns(spark, stored_silver):
    orders, items, payments = stored_silver
    scans = re.findall(r"ReadSchema: struct<(.*?)>", gold.daily_sales(orders, items, payments)._jdf.queryExecution().executedPlan().treeString())
    assert any("price" in s for s in scans) and not any("note" in s or "seller_id" in s for s in scans)


def test_marts_never_meet_in_one_task(stored_silver, spark):
    orders, items, payments = stored_silver
    products = spark.sql(
        "select cast(id as string) product_id, 'c' product_category_name, 'e' product_category_name_english from range(30)"
    )
    customers = spark.sql(
        "select cast(id as string) customer_id, 'u' customer_unique_id, 'x' customer_city, 'RJ' customer_state from range(50)"
    )
    for mart in (
        gold.daily_sales(orders, items, payments),
        gold.category_sales(items, products, orders),
        gold.customer_values(orders, customers, payments),
    ):
        text = plan(mart)
        assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_date_filter_prunes_folders(stored_silver):
    orders = stored_silver[0]
    text = plan(orders.where("order_purchase_date = date'2020-01-03'"))
    assert "order_purchase_date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_refresh_reads_only_the_dates_touched(spark, stored_silver):
    orders, items, payments = stored_silver
    changed = payments.where("payment_value > 998")
    dates = refresh.affected_dates(changed, orders)
    found = refresh.orders_of_dates(orders, dates)
    assert "dynamicpruning" in plan(found) and "NestedLoop" not in plan(found)
    assert found.count() == 50
    with_none = dates.unionByName(dates.selectExpr("cast(null as date) order_purchase_date"))
    undated = orders.selectExpr("* except(order_purchase_date)", "cast(null as date) order_purchase_date")
    both = orders.unionByName(undated.limit(7))
    assert refresh.orders_of_dates(both, with_none).count() == 57
    assert refresh.orders_of_dates(both, dates).count() == 50


def test_category_sales_equal_with_and_without_broadcast(spark, stored_silver):
    orders, items, _ = stored_silver
    hot = items.withColumn("product_id", F.when(F.hash("order_item_key") % 3 == 0, "1").otherwise(F.col("product_id")))
    products = spark.sql(
        "select cast(id as string) product_id, concat('c', id % 4) product_category_name, "
        "cast(null as string) product_category_name_english from range(25)"
    )
    small = gold.category_sales(hot, products, orders)
    expected = rows(small, *small.columns)
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        large = gold.category_sales(hot, products, orders)
        assert "BroadcastHashJoin" not in plan(large)
        assert rows(large, *small.columns) == expected
    finally:
        spark.conf.set(name, before)
    brute = (
        hot.join(products, "product_id", "left")
        .join(orders.select("order_id", "order_purchase_date"), "order_id", "left")
        .groupBy("order_purchase_date", F.coalesce("product_category_name", F.lit("unknown")).alias("category_name"))
        .agg(F.count_distinct("order_id").alias("o"), F.count_distinct("order_item_key").alias("i"), F.sum("price").alias("p"))
    )
    assert rows(small, "order_purchase_date", "category_name", "order_count", "item_count", "gross_item_value") == rows(
        brute, "order_purchase_date", "category_name", "o", "i", "p"
    )


def test_translation_is_broadcast(spark):
    base = spark.sql("select id product_id, cast(id % 3 as string) product_category_name from range(9)")
    words = spark.sql("select cast(id as string) product_category_name, 'b' product_category_name_english from range(2)")
    assert "BroadcastHashJoin" in plan(silver.products(base, words))


def test_contracts_cover_three_layers():
    layers = [c.layer for c in CONTRACTS.values()]
    assert (layers.count("bronze"), layers.count("silver"), layers.count("gold")) == (9, 10, 3)
