"""Every operator and table as a named query over the star-schema tables of a folder."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS
from lakemart.operators import checks, dedupe, history, ranking, versions
from lakemart.plans import bronze, build, deltas, extended, gold, quality, refresh, reports, silver
from lakemart.session import lean, new_table_path, stored
from lakemart.sources import adapters, change_log, files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


class Tables:
    """The tables of one folder, each put together when first asked for.

    The tables named in ``keep`` are stored, because several parts of a query read them; a mapping names the
    columns those parts read.
    """

    def __init__(
        self, spark: SparkSession, folder: str, *, keep: Collection[str] | Mapping[str, Sequence[str]] = ()
    ) -> None:
        self.spark, self.folder, self.keep = spark, folder, keep
        self.table = cache(self._table)

    def bronze(self, name: str) -> DataFrame:
        # Record keys of reviews and geolocation are made from the raw text.
        return adapters.bronze(
            self.spark, self.folder, name, as_text=name in ("reviews", "geolocation")
        )

    def _table(self, name: str) -> DataFrame:
        if name in silver.SILVER:
            make, source = silver.SILVER[name]
            made = make(self.bronze(source.removesuffix("_bronze")))
        else:
            made = silver.products(
                self.table("products_silver_base"), self.table("product_category_translation_silver")
            )
        if name not in self.keep:
            return made
        return stored(made.select(*self.keep[name]) if isinstance(self.keep, Mapping) else made, name)

    @property
    def orders(self) -> DataFrame:
        return self.table("orders_silver")

    @property
    def items(self) -> DataFrame:
        return self.table("order_items_silver")

    @property
    def payments(self) -> DataFrame:
        return self.table("payments_silver")

    @property
    def customers(self) -> DataFrame:
        return self.table("customers_silver")

    @property
    def products(self) -> DataFrame:
        return self.table("products_silver")

    @property
    def sellers(self) -> DataFrame:
        return self.table("sellers_silver")

    @property
    def reviews(self) -> DataFrame:
        return self.table("reviews_silver")

    @property
    def daily(self) -> DataFrame:
        return gold.daily_sales(self.orders, self.items, self.payments)

    @property
    def category(self) -> DataFrame:
        return gold.category_sales(self.items, self.products, self.orders)

    @cached_property
    def totals(self) -> DataFrame:
        """What both date marts add up, stored: a row per date and category."""
        totals = gold.date_category_totals(self.items, self.products, self.orders)
        return stored(totals, "date_category_totals")

    @property
    def date_marts(self) -> tuple[DataFrame, DataFrame]:
        """The daily and the category mart from one pass over the items."""
        daily = gold.daily_from_totals(self.orders, self.payments, self.totals)
        return daily, gold.category_from_totals(self.totals)

    @property
    def customer_values(self) -> DataFrame:
        return gold.customer_values(self.orders, self.customers, self.payments)

    @property
    def ltv(self) -> DataFrame:
        return gold.customer_ltv(self.orders, self.customers, self.payments)


# ---- the 22 tables -------------------------------------------------------------------------------


def _bronze_query(name: str) -> Query:
    return lambda spark, folder: adapters.bronze(spark, folder, name, as_text=True)


def _silver_query(name: str) -> Query:
    return lambda spark, folder: Tables(spark, folder).table(name)


for _name, _key in {
    "orders": "bronze_orders",
    "order_items": "bronze_order_items",
    "customers": "bronze_customers",
    "payments": "bronze_payments",
    "products": "bronze_products",
    "sellers": "bronze_sellers",
    "reviews": "bronze_reviews",
    "geolocation": "bronze_geolocation",
    "product_category_translation": "bronze_category_translation",
}.items():
    QUERIES[_key] = _bronze_query(_name)

for _name, _key in {
    "orders_silver": "silver_orders",
    "order_items_silver": "silver_order_items",
    "customers_silver": "silver_customers",
    "payments_silver": "silver_payments",
    "products_silver_base": "silver_products_base",
    "products_silver": "silver_products",
    "sellers_silver": "silver_sellers",
    "reviews_silver": "silver_reviews",
    "geolocation_silver": "silver_geolocation",
    "product_category_translation_silver": "silver_category_translation",
}.items():
    QUERIES[_key] = _silver_query(_name)


@query
def gold_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).daily


@query
def gold_category_sales(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).category


@query
def gold_customer_ltv(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).ltv


# ---- reports -------------------------------------------------------------------------------------


@query
def report_daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.daily_trend(Tables(spark, folder).daily)


@query
def report_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_sales(Tables(spark, folder).daily)


@query
def report_top_categories_value(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_categories_by_value(Tables(spark, folder).category)


@query
def report_top_categories_orders(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_categories_by_orders(Tables(spark, folder).category)


@query
def report_top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_customers(Tables(spark, folder).customer_values)


@query
def report_top_states(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_states(Tables(spark, folder).customer_values)


@query
def report_monthly_category_leaders(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_category_leaders(Tables(spark, folder).category)


@query
def report_freight_efficiency(spark: SparkSession, folder: str) -> DataFrame:
    return reports.freight_efficiency(Tables(spark, folder).daily)


@query
def report_gold_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    return reports.gold_counts(tables.daily, tables.category, tables.customer_values)


@query
def report_latest_rows_daily(spark: SparkSession, folder: str) -> DataFrame:
    return reports.latest_daily(Tables(spark, folder).daily)


@query
def report_latest_rows_category(spark: SparkSession, folder: str) -> DataFrame:
    return reports.latest_categories(Tables(spark, folder).category)


@query
def report_latest_rows_ltv(spark: SparkSession, folder: str) -> DataFrame:
    return reports.best_customers(Tables(spark, folder).customer_values)


# ---- checks --------------------------------------------------------------------------------------


FACTS = ("orders_silver", "order_items_silver", "payments_silver")


@query
def check_quality(spark: SparkSession, folder: str) -> DataFrame:
    # The items are read once, for the totals of both date marts.
    t = Tables(spark, folder, keep=("orders_silver", "payments_silver"))
    daily, category = t.date_marts
    gold_tables = {"daily_sales_gold": daily, "category_sales_gold": category, "customer_ltv_gold": t.ltv}
    checked = [rule.table for rule in quality.rules()]
    silver_tables = {name: t.table(name) for name in checked if name.endswith("_silver")}
    return quality.quality(silver_tables | gold_tables)


@query
def check_freshness(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder, keep=FACTS)
    return quality.freshness(t.orders, t.items, t.daily, t.category, t.customer_values)


@query
def check_reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder, keep=FACTS)
    return quality.reconcile_counts(t.orders, t.items, t.daily, t.category, t.customer_values)


@query
def check_reconcile_values(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder, keep=FACTS)
    return quality.reconcile_values(t.items, t.payments, *t.date_marts, t.customer_values)


# What the marts and their expected rows read of the tables stored for them.
COUNTED = {
    "orders_silver": ("order_id", "customer_id", "order_purchase_date"),
    "order_items_silver": ("order_id", "order_item_key", "product_id", "seller_id", "price", "freight_value"),
    "payments_silver": ("order_id", "payment_value"),
    "products_silver_base": ("product_id", "product_category_name"),
}


@query
def check_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all 22 tables against rows and distinct keys counted in the source frames."""
    t = Tables(spark, folder, keep=COUNTED)
    tables = {}
    for name in CONTRACTS:
        if name.endswith("_bronze"):
            tables[name] = t.bronze(name.removesuffix("_bronze"))
        elif "_silver" in name:
            tables[name] = t.table(name)
    tables |= {"daily_sales_gold": t.daily, "category_sales_gold": t.category, "customer_ltv_gold": t.ltv}

    def raw(name: str) -> DataFrame:
        return adapters.raw(spark, folder, name)

    distinct = {
        "orders_silver": raw("orders").select("order_id"),
        "order_items_silver": raw("order_items").select("order_id", "order_item_id"),
        "customers_silver": raw("customers").select("customer_id"),
        "payments_silver": raw("payments").select("order_id", "payment_sequential"),
        "products_silver_base": raw("products").select("product_id"),
        "products_silver": raw("products").select("product_id"),
        "sellers_silver": raw("sellers").select("seller_id"),
        "reviews_silver": raw("reviews").select("review_id"),
        "geolocation_silver": raw("geolocation").select(
            "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"
        ),
        "product_category_translation_silver": raw("product_category_translation").select(
            "product_category_name"
        ),
        "daily_sales_gold": t.orders.select("order_purchase_date"),
        # Each item meets its order in one shuffle; the dates and categories found are few.
        "category_sales_gold": extended.items_with_category(t.items, t.products)
        .select("order_id", "category_name")
        .join(t.orders.select("order_id", "order_purchase_date"), "order_id", "left")
        .select("order_purchase_date", "category_name"),
        "customer_ltv_gold": t.orders.select("customer_id"),
    }
    expected = {f"{name}_bronze": raw(name) for name in bronze.BRONZE}
    expected |= {name: keys.distinct() for name, keys in distinct.items()}
    counted = checks.count_rows(expected).withColumnRenamed("row_count", "expected_rows")
    return quality.row_counts(tables, counted)


@query
def check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order statuses and their rows; status ``p`` is not on the list."""
    return checks.accepted_values(Tables(spark, folder).orders, "order_status", ["f", "o"])


@query
def check_partition_completeness(spark: SparkSession, folder: str) -> DataFrame:
    return checks.partition_completeness(Tables(spark, folder).bronze("orders"), "dt")


@query
def check_row_count_drift(spark: SparkSession, folder: str) -> DataFrame:
    return checks.row_count_drift(Tables(spark, folder).bronze("orders"), "dt")


@query
def check_drift_history(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of each day next to those of the eight same weekdays before."""
    measures = history.daily_measures(Tables(spark, folder).bronze("orders"), "dt", "orders_bronze")
    found = history.drift_from_history(measures)
    rounded = [F.round(name, 6).alias(name) for name in ("usual", "spread")]
    return found.select("day", "table_name", "row_count", "earlier_loads", *rounded, "passed")


@query
def rejected_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values of the items' text that are no numbers or dates, per column."""
    return bronze.rejected_values(adapters.raw(spark, folder, "order_items", as_text=True), "order_items")


@query
def orphan_items(spark: SparkSession, folder: str) -> DataFrame:
    """Items whose order is not among the delivered or lost ones: those of open orders."""
    t = Tables(spark, folder)
    closed = t.orders.where("order_status <> 'o'")
    return quality.orphan_items(t.items, closed).select("order_item_key", "order_id", "price")


@query
def semi_join_orders_with_items(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return quality.orders_with_items(t.orders, t.items).select("order_id", "order_purchase_date")


@query
def smoke_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The first five bronze orders with the number of all of them."""
    orders = Tables(spark, folder).bronze("orders")
    sample = orders.orderBy("order_id").limit(5).select("order_id", "customer_id", "order_status", "dt")
    return sample.withColumn("total_rows", orders.agg(F.count("*")).scalar())


# ---- versioned tables ----------------------------------------------------------------------------

USER, TS = "user_id", "ts"


@query
def upsert_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Users' state up to a day, with the later events merged in."""
    log = adapters.event_log(spark, folder)
    current = versions.as_of(log, USER, TS, "20240115")
    incoming = log.where(F.col("_commit_time") > "20240115")
    return versions.upsert(current, incoming, USER, TS)


@query
def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return versions.snapshot(adapters.event_log(spark, folder), USER, TS)


@query
def as_of(spark: SparkSession, folder: str) -> DataFrame:
    return versions.as_of(adapters.event_log(spark, folder), USER, TS, "20240115")


@query
def instants(spark: SparkSession, folder: str) -> DataFrame:
    return versions.instants(adapters.event_log(spark, folder))


@query
def latest_instant(spark: SparkSession, folder: str) -> DataFrame:
    return versions.newest_instants(adapters.event_log(spark, folder), 1)


@query
def previous_instant(spark: SparkSession, folder: str) -> DataFrame:
    last_two = versions.newest_instants(adapters.event_log(spark, folder), 2)
    return last_two.agg(F.min("_commit_time").alias("_commit_time"))


@query
def version_diff(spark: SparkSession, folder: str) -> DataFrame:
    log = adapters.event_log(spark, folder)
    before, after = (versions.as_of(log, USER, TS, day) for day in ("20240110", "20240111"))
    return versions.version_diff(before, after, USER, ["event_type", "value"])


@query
def changes_since(spark: SparkSession, folder: str) -> DataFrame:
    return versions.changes_since(adapters.event_log(spark, folder), USER, TS, "20240129")


@query
def delete_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose newest event is an error count as deleted."""
    log = adapters.event_log(spark, folder).withColumn("deleted", F.col("event_type") == "error")
    return versions.snapshot(log, USER, TS, deleted="deleted")


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """The newest line of every order and line number, on the raw table."""
    return dedupe.latest_per_key(
        adapters.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


@query
def number_equal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with its number among the lines of the same order and part."""
    lines = adapters.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return dedupe.number_equal_rows(lines, "ordinal")


@query
def global_row_number(spark: SparkSession, folder: str) -> DataFrame:
    """All orders ranked by their total."""
    orders = adapters.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ranking.global_row_number(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], "price_rank")


@query
def top_n_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """The three largest orders of every customer."""
    orders = adapters.table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_n_per_group(
        orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "place"
    )


# ---- further tables ------------------------------------------------------------------------------


@query
def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return extended.order_facts(t.orders, t.items)


@query
def order_payment_facts(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return extended.order_payment_facts(extended.order_facts(t.orders, t.items), t.payments)


@query
def customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return extended.customer_orders(t.orders, t.customers)


@query
def sales_enriched(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return extended.sales_enriched(t.items, t.products, t.sellers)


@query
def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return extended.order_reviews(t.orders, t.reviews)


@query
def products_api_silver(spark: SparkSession, folder: str) -> DataFrame:
    translation = Tables(spark, folder).table("product_category_translation_silver")
    return extended.products_api(adapters.product_feed(spark, folder), translation)


@query
def products_current(spark: SparkSession, folder: str) -> DataFrame:
    return extended.products_current(Tables(spark, folder).products, products_api_silver(spark, folder))


@query
def delivery_performance(spark: SparkSession, folder: str) -> DataFrame:
    return extended.delivery_performance(Tables(spark, folder).orders)


@query
def seller_performance(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return extended.seller_performance(t.items, t.sellers)


@query
def customer_satisfaction(spark: SparkSession, folder: str) -> DataFrame:
    return extended.customer_satisfaction(Tables(spark, folder).reviews)


@query
def payment_type_summary(spark: SparkSession, folder: str) -> DataFrame:
    return extended.payment_type_summary(Tables(spark, folder).payments)


def _late_shipments(t: Tables) -> DataFrame:
    return t.items.where("shipping_limit_date >= '2001-06-01'").select("order_id")


@query
def refresh_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Daily rows of the dates touched by the items shipped since June 2001."""
    t = Tables(spark, folder)
    dates = refresh.affected_dates(_late_shipments(t), t.orders)
    return refresh.refresh_daily_sales(t.orders, t.items, t.payments, dates)


@query
def refresh_category_sales(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    dates = refresh.affected_dates(_late_shipments(t), t.orders)
    return refresh.refresh_category_sales(t.items, t.products, t.orders, dates)


@query
def refresh_customer_ltv(spark: SparkSession, folder: str) -> DataFrame:
    """The customer mart of the orders before 2001, brought up to date with the orders since."""
    t = Tables(spark, folder, keep=FACTS)
    since = F.col("order_purchase_date") >= "2001-01-01"
    before, new = t.orders.where(~since), t.orders.where(since)
    mart = gold.customer_values(before, t.customers, t.payments)
    affected = refresh.affected_customers(new, t.orders)
    return refresh.refresh_customer_ltv(mart, t.orders, t.customers, t.payments, affected)


# ---- sources and sinks over the shared folder ----------------------------------------------------


@query
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw items written as CSV text and loaded to bronze from the files."""
    path = new_table_path(spark, "items-csv")
    adapters.raw(spark, folder, "order_items", as_text=True).write.option("header", "true").csv(path)
    return bronze.order_items(files.read_raw(spark, "order_items", path))


@query
def multi_line_csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews hold line breaks and quotes; written as CSV and read back whole."""
    path = new_table_path(spark, "reviews-csv")
    raw = adapters.raw(spark, folder, "reviews", as_text=True)
    raw.write.options(header="true", quote='"', escape='"', quoteAll="true").csv(path)
    read = bronze.read_types(files.read_raw(spark, "reviews", path), "reviews")
    return read.select("review_id", "order_id", "review_score", "review_comment_message")


@query
def json_feed_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The product feed landed as JSON by day and read back with its day."""
    path = new_table_path(spark, "feed-json")
    adapters.product_feed(spark, folder).write.partitionBy("dt").json(path)
    return files.read_product_feed(spark, path)


@query
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table by order status; one status is written again and the others stay."""
    path = new_table_path(spark, "orders-by-status")
    orders = Tables(spark, folder).orders.select("order_id", "customer_id", "order_status")
    files.write_parquet(orders, path, partition="order_status")
    again = orders.where("order_status = 'f'").withColumn("customer_id", F.lit("changed"))
    files.write_parquet(again, path, partition="order_status", replace_touched_only=True)
    files.register_views({"orders_by_status": files.read_parquet(spark, path)})
    return spark.sql("SELECT order_id, customer_id, order_status FROM orders_by_status")


@query
def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """What three commits of items did: prices of a fifth changed, a fifth deleted, a fifth new; with late rows.

    A row of the second commit is late for a seventh of the items: its shipping date is a day older, so it changes nothing.
    """
    path = new_table_path(spark, "items-feed")
    contract = CONTRACTS["order_items_silver"]
    columns = ["order_item_key", "shipping_limit_date", "dt", "price"]
    items = stored(Tables(spark, folder).items.select(*columns), "feed_items")
    order, line = (F.split_part("order_item_key", F.lit("_"), F.lit(i)).cast("long") for i in (1, 2))
    turn = order * 3 + line
    fifth, late = turn % 5, turn % 7 == 0
    change_log.overwrite_log(items.where(fifth != 0), path, contract, "1", by_month=True, keyed=True)
    dearer = items.where(fifth <= 1).withColumn("price", F.when(fifth == 1, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(12,2)"))
    older = F.when(late & (fifth == 1), F.col("shipping_limit_date") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("shipping_limit_date"))
    change_log.append_commit(dearer.withColumn("shipping_limit_date", older), path, contract, "2", keyed=True)
    change_log.append_commit(versions.deletions(items.where(fifth == 2)), path, contract, "3", keyed=True)
    feed = change_log.change_feed(spark, path, contract, since="1")
    return feed.select("_commit_time", "change_type", "order_item_key", "price", F.col("_before.price").alias("price_before"))


@query
def change_log_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze items stored as a versioned table in two commits, read as of the last one."""
    path = new_table_path(spark, "items-log")
    contract = CONTRACTS["order_items_bronze"]
    items = Tables(spark, folder).bronze("order_items").select(
        "order_item_key", "order_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"
    )
    early = F.col("shipping_limit_date") < "1998-01-01"
    items = items.withColumn("dt", F.to_date("shipping_limit_date"))
    change_log.overwrite_log(items.where(early), path, contract, "20240101000000000", by_month=True)
    change_log.append_commit(items.where(~early), path, contract, "20240102000000000")
    return change_log.read_table(spark, path, contract, table_format="log").drop("dt")


def _two_loads(spark: SparkSession, folder: str, table_format: str) -> DataFrame:
    """The daily mart after the raw files were loaded in two runs of the whole build.

    A quarter of the orders comes with the second load only, another quarter moves then from an
    earlier day; some days are left without orders. The other files of the second load are empty.
    Dates are rounded to the year, which keeps the date folders of the tables few.
    """
    root = new_table_path(spark, f"append-{table_format}")
    part = F.crc32(F.col("order_id").cast("binary")) % 4
    days = {"orders": "order_purchase_timestamp", "order_items": "shipping_limit_date"}

    def year(name: str) -> Column:
        return F.date_trunc("year", F.col(days[name]).cast("timestamp"))

    def load(number: int) -> dict[str, DataFrame]:
        paths = {}
        for name in build.RAW_FILES:
            raw = adapters.raw(spark, folder, name, as_text=True)
            if name in days:
                raw = raw.withColumn(days[name], year(name).cast("string"))
            if name == "orders" and number == 1:
                earlier = (year(name) - F.expr("INTERVAL 40 DAYS")).cast("string")
                raw = raw.where(part != 0).withColumn(days[name], F.when(part == 1, earlier).otherwise(F.col(days[name])))
            elif name == "orders":
                raw = raw.where(part <= 1)
            elif number == 2:
                raw = raw.limit(0)
            paths[name] = f"{root}/raw-{number}/{name}"
            # Compressed files cannot be split, so they are many of moderate size.
            packed = raw.write.options(compression="gzip", maxRecordsPerFile=1_000_000)
            packed.options(header="true", quote='"', escape='"', quoteAll="true").csv(paths[name])
        return build.run_all(
            spark,
            paths,
            f"{root}/tables",
            ingested_at=f"2024-01-0{number} 00:00:00",
            table_format=table_format,
            mode="overwrite" if number == 1 else "append",
            commit_time=str(number),
        )

    load(1)
    return load(2)["daily_sales_gold"].drop(versions.COMMIT)


@query
def append_build_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """The build run twice over plain Parquet tables equals one run over all files."""
    return _two_loads(spark, folder, "parquet")


@query
def append_build_log(spark: SparkSession, folder: str) -> DataFrame:
    """The build run twice over versioned tables equals one run over all files."""
    return _two_loads(spark, folder, "log")


@query
def refresh_after_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Both date marts after products, payments and orders were deleted in bronze and silver was refreshed."""
    root = new_table_path(spark, "refresh-delete")
    tables = {name: Tables(spark, folder).bronze(name) for name in build.RAW_FILES}
    for name, df in tables.items():
        contract = CONTRACTS[f"{name}_bronze"]
        change_log.overwrite_log(df, build.table_path(root, contract), contract, "1", by_month=True)
    bronze_tables = {f"{name}_bronze": build.open_table(spark, root, f"{name}_bronze", "log") for name in tables}

    def keep(name: str, df: DataFrame) -> DataFrame:
        contract = CONTRACTS[name]
        change_log.overwrite_log(df, build.table_path(root, contract), contract, "1", by_month=True, keyed=True)
        return build.open_table(spark, root, name, "log").drop(versions.COMMIT)

    build.derive_silver(bronze_tables, keep=keep, keyed=True)

    gone = {
        "orders": "cast(order_id as long) % 7 = 0",
        "payments": "cast(order_id as long) % 5 = 0",
        "products": "cast(product_id as long) % 3 = 0",
    }
    for name, condition in gone.items():
        contract = CONTRACTS[f"{name}_bronze"]
        rows = bronze_tables[contract.name].where(condition).drop(versions.COMMIT)
        change_log.append_commit(versions.deletions(rows), build.table_path(root, contract), contract, "2", keyed=True)
    refresh.refresh_silver(spark, root, since="1", commit_time="2")
    left = {name: build.open_table(spark, root, f"{name}_silver", "log") for name in ("orders", "order_items", "payments", "products")}
    daily = gold.daily_sales(left["orders"], left["order_items"], left["payments"])
    category = gold.category_sales(left["order_items"], left["products"], left["orders"])
    value = F.col("gross_item_value").cast("decimal(32,2)").alias("gross_item_value")
    columns = ("gold_key", "order_count", "item_count", value)
    paid = F.col("payment_value").cast("decimal(32,2)").alias("payment_value")
    return daily.select(*columns, paid).unionByName(category.select(*columns), allowMissingColumns=True)


def _log_tables(spark: SparkSession, root: str, bronze_tables: dict[str, DataFrame]) -> None:
    """Bronze tables as the first commit of versioned ones, and silver and the marts derived from them."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        contract = CONTRACTS[name]
        keyed = contract.layer == "silver"
        path, placed = build.table_path(root, contract), name in silver.SAME_KEY
        change_log.overwrite_log(df, path, contract, "1", by_month=True, keyed=keyed, placed=placed)
        return build.open_table(spark, root, name, "log").drop(versions.COMMIT)

    with lean(spark):
        build.derive({name: keep(name, df) for name, df in bronze_tables.items()}, keep=keep, keyed=True)


@query
def refresh_all(spark: SparkSession, folder: str) -> DataFrame:
    """The three marts after a delta load of orders, items and payments, refreshed in one call.

    A quarter of the orders is new in the second load and another quarter moves from an earlier day; a fifth of the
    items and payments is new, and a fifth of the items had another price. What is left equals the marts of all rows.
    """
    root = new_table_path(spark, "refresh-all")
    tables = {f"{name}_bronze": Tables(spark, folder).bronze(name) for name in build.RAW_FILES}
    orders, items, payments = (tables[f"{n}_bronze"] for n in ("orders", "order_items", "payments"))
    quarter, fifth = (lambda c: F.crc32(F.col(c).cast("binary")) % 4), (lambda c: F.crc32(F.col(c).cast("binary")) % 5)
    earlier = F.col("order_purchase_timestamp") - F.expr("INTERVAL 40 DAYS")
    moved = F.when(quarter("order_id") == 1, earlier).otherwise(F.col("order_purchase_timestamp"))
    first = orders.where(quarter("order_id") != 0).withColumn("order_purchase_timestamp", moved)
    price = F.when(fifth("order_item_key") == 1, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(12,2)")
    seed = {
        "orders_bronze": first.withColumn("dt", F.to_date("order_purchase_timestamp")),
        "order_items_bronze": items.where(fifth("order_item_key") != 0).withColumn("price", price),
        "payments_bronze": payments.where(fifth("payment_key") != 0),
    }
    _log_tables(spark, root, tables | seed)
    deltas.start_ranking(spark, root)
    load = {
        "orders_bronze": orders.where(quarter("order_id") <= 1),
        "order_items_bronze": items.where(fifth("order_item_key") <= 1),
        "payments_bronze": payments.where(fifth("payment_key") == 0),
    }
    for name, rows in load.items():
        contract = CONTRACTS[name]
        change_log.append_commit(rows, build.table_path(root, contract), contract, "2")
    deltas.refresh_all(spark, root, since="1", commit_time="2")

    value = F.col("gross_item_value").cast("decimal(32,2)").alias("value")
    daily = build.open_table(spark, root, "daily_sales_gold", "log").select(
        F.lit("daily").alias("mart"), "gold_key", "order_count", "item_count", value, F.col("avg_order_payment_value").alias("average")
    )
    category = build.open_table(spark, root, "category_sales_gold", "log").select(
        F.lit("category").alias("mart"), "gold_key", "order_count", "item_count", value
    )
    customers = deltas.ranked_customers(spark, root).select(
        F.lit("customer").alias("mart"), F.col("customer_id").alias("gold_key"), "order_count",
        F.col("ltv_rank").cast("long").alias("item_count"), F.col("lifetime_value").cast("decimal(32,2)").alias("value"),
    )
    return daily.unionByName(category, allowMissingColumns=True).unionByName(customers, allowMissingColumns=True)
