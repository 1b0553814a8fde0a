"""From raw CSV files to marts, reports and checks, in both table formats; delta loads and streams."""

import csv
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS, RAW_FILES
from lakemart.operators import checks, versions
from lakemart.operators.checks import enforce
from lakemart.plans import build, gold, quality, refresh, reports, silver
from lakemart.sources import change_log, files
from lakemart.streaming.commits import merge_landing_files
from tests.compare import rows

N = 60


def raw_rows():
    """A small shop: every order has a payment and most have items; reviews hold line breaks."""
    rng = random.Random(5)
    day = lambda n: f"2018-{1 + n % 3:02d}-{1 + n % 27:02d} 10:00:00"
    data = {name: [] for name in RAW_FILES}
    for n in range(N):
        data["orders"].append([f"o{n}", f"c{n % 20}", " Delivered", day(n), day(n), "", day(n + 2), day(n + 1)])
        data["payments"].append([f"o{n}", 1, "Credit_Card", n % 4, f"{10 + n}.50"])
        data["reviews"].append([f"r{n % 50}", f"o{n}", 1 + n % 5, "", f'said "ok"\nline {n}', day(n), day(n + 3)])
        for item in range(1, 1 + n % 3):
            data["order_items"].append(
                [f"o{n}", item, f"p{rng.randrange(8)}", f"s{n % 3}", day(n + 1), f"{5 + item}.25", "1.10"]
            )
    data["orders"].append(["solo", "c1", "shipped", "2018-06-01 10:00:00", "", "", "", ""])
    data["payments"].append(["solo", 1, "voucher", 1, "12.00"])
    data["order_items"].append(["solo", 1, "p0", "s0", "2018-06-02 10:00:00", "7.00", "1.00"])
    for n in range(20):
        data["customers"].append([f"c{n}", f"u{n}", f"0{n:04d}", "sao paulo", "sp"])
    for n in range(8):
        data["products"].append([f"p{n}", ["Beleza", "", "jogos"][n % 3], 5, 9, 1, 100, "", 3, 4])
    for n in range(3):
        data["sellers"].append([f"s{n}", "01001", "rio", "rj"])
    data["geolocation"] = [["01037", "-23.5", "-46.6", "sao paulo", "sp"]] * 3 + [["01038", "-23.6", "-46.7", "x", "sp"]]
    data["product_category_translation"] = [["beleza", "beauty"]]
    return data


def write_csv(folder: Path, data) -> dict[str, str]:
    paths = {}
    for name, lines in data.items():
        path = folder / f"{name}.csv"
        with open(path, "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(RAW_FILES[name].columns)
            writer.writerows(lines)
        paths[name] = str(path)
    return paths


@pytest.fixture(scope="module", params=["parquet", "log"])
def built(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp(f"raw-{request.param}")
    paths = write_csv(folder, raw_rows())
    root = str(folder / "tables")
    tables = build.run_all(
        spark,
        paths,
        root,
        batch_id="b1",
        ingested_at="2024-01-01 00:00:00",
        table_format=request.param,
        commit_time="20240101000000000",
    )
    return tables, root, request.param


def test_all_checks_pass(built):
    tables = built[0]
    assert list(tables) == list(CONTRACTS)
    expected = {name: df.count() for name, df in tables.items()}
    assert (expected["reviews_bronze"], expected["reviews_silver"]) == (N, 50)
    assert (expected["geolocation_bronze"], expected["geolocation_silver"]) == (4, 2)
    quality.gate(tables, expected)
    with pytest.raises(Exception, match="orders_silver"):
        enforce(quality.row_counts(tables, expected | {"orders_silver": 1}))


def test_document_checks_stop_where_asked_for(built):
    orders, day = built[0]["orders_silver"], CONTRACTS["orders_silver"].partition
    statuses = [row[0] for row in orders.select("order_status").distinct().collect()]
    enforce(checks.accepted_values(orders, "order_status", statuses))
    with pytest.raises(checks.ChecksFailed, match=f"value={statuses[0]}"):
        quality.gate(built[0], accepted_status=statuses[1:])
    one, two, four = ((d, f"2024-01-0{d}") for d in (1, 2, 4))
    days = orders.sparkSession.createDataFrame([one, one, two, four, four], "n int, d string").selectExpr("n", f"date(d) AS {day}")
    assert [r["day"].day for r in checks.partition_completeness(days, day).where("NOT passed").collect()] == [3]
    assert checks.row_count_drift(days, day, 1.0).where("NOT passed").count() == 0
    assert [r["day"].day for r in checks.row_count_drift(days, day).where("NOT passed").collect()] == [4]


def test_reports_equal_sql_on_views(spark, built):
    tables = built[0]
    files.register_views(tables)
    daily, category, ltv = (tables[f"{n}_gold"] for n in ("daily_sales", "category_sales", "customer_ltv"))
    statements = [
        (
            reports.daily_trend(daily),
            "SELECT order_date, order_count, item_count, payment_value, avg_order_payment_value FROM daily_sales_gold",
        ),
        (
            reports.top_categories_by_value(category),
            """SELECT category_name, SUM(order_count) order_count, SUM(item_count) item_count,
               ROUND(SUM(gross_item_value), 2) gross_item_value, ROUND(SUM(gross_freight_value), 2) gross_freight_value
               FROM category_sales_gold GROUP BY 1 ORDER BY gross_item_value DESC LIMIT 15""",
        ),
        (
            reports.top_categories_by_orders(category),
            """SELECT category_name, SUM(order_count) order_count, ROUND(SUM(gross_item_value), 2) gross_item_value
               FROM category_sales_gold GROUP BY 1 ORDER BY order_count DESC LIMIT 15""",
        ),
        (
            reports.top_customers(ltv),
            """SELECT customer_id, customer_unique_id, customer_city, customer_state, order_count,
               ROUND(lifetime_value, 2) lifetime_value, ROUND(avg_order_value, 2) avg_order_value, first_order_date,
               last_order_date, ltv_rank FROM customer_ltv_gold ORDER BY lifetime_value DESC, customer_id LIMIT 20""",
        ),
        (
            reports.monthly_category_leaders(category),
            """WITH ranked AS (SELECT CAST(date_trunc('month', order_purchase_date) AS DATE) sales_month, category_name,
               ROUND(SUM(gross_item_value), 2) gross_item_value,
               ROW_NUMBER() OVER (PARTITION BY date_trunc('month', order_purchase_date)
                                  ORDER BY SUM(gross_item_value) DESC, category_name) category_rank
               FROM category_sales_gold GROUP BY date_trunc('month', order_purchase_date), category_name)
               SELECT sales_month, category_name, gross_item_value FROM ranked WHERE category_rank <= 3""",
        ),
        (
            reports.freight_efficiency(daily),
            """SELECT order_date, payment_value, gross_item_value, gross_freight_value,
               ROUND(payment_value - gross_freight_value, 2) payment_minus_freight,
               ROUND(gross_freight_value / NULLIF(payment_value, 0), 4) freight_ratio FROM daily_sales_gold""",
        ),
    ]
    for report, statement in statements:
        assert rows(report, *report.columns) == rows(spark.sql(statement), *report.columns)


def test_exports(spark, built, tmp_path):
    daily, category, ltv = (built[0][f"{n}_gold"] for n in ("daily_sales", "category_sales", "customer_ltv"))
    reports.export_reports(daily, category, ltv, str(tmp_path))
    folders = {p.name for p in tmp_path.iterdir()}
    assert folders == {
        "daily_sales_trend",
        "monthly_sales_summary",
        "top_categories_by_revenue",
        "top_customers_by_ltv",
    }
    lines = next((tmp_path / "top_customers_by_ltv").glob("*.csv")).read_text().splitlines()
    assert lines[0].startswith("customer_id,customer_unique_id") and len(lines) == 21


def test_external_tables(spark, built):
    tables, root, table_format = built
    if table_format == "log":
        pytest.skip("plain Parquet tables only")
    names = ["daily_sales_gold", "category_sales_gold", "customer_ltv_gold"]
    paths = {f"{name}_x": build.table_path(root, CONTRACTS[name]) for name in names}
    files.register_external_tables(spark, paths)
    try:
        listed = {t.name for t in spark.catalog.listTables()}
        assert set(paths) <= listed
        for name in names:
            counted = spark.sql(f"SELECT count(*) FROM {name}_x").first()[0]
            assert counted == tables[name].count() > 0
        days = spark.sql("SHOW PARTITIONS daily_sales_gold_x").count()
        assert days == tables["daily_sales_gold"].count()
    finally:
        for name in paths:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partition_folders(built):
    tables, root, table_format = built
    folders = {p.name for p in Path(f"{root}/gold/daily_sales_gold").iterdir() if p.is_dir()}
    prefix = "order_date=" if table_format == "parquet" else "_commit_time="
    assert folders and all(name.startswith(prefix) for name in folders)


def test_running_again_gives_the_same_tables(spark, built, tmp_path):
    tables, _, table_format = built
    if table_format == "log":
        pytest.skip("one format is enough")
    again = build.run_all(
        spark,
        write_csv(tmp_path, raw_rows()),
        str(tmp_path / "tables"),
        batch_id="b1",
        ingested_at="2024-01-01 00:00:00",
    )
    for name, df in tables.items():
        assert rows(df, *sorted(df.columns)) == rows(again[name], *sorted(df.columns)), name


def delta(spark):
    """Orders o3 and solo move to another day, solo's day is left without orders, o9 gets one more item, o5 pays less, o7 not validly; a category is renamed."""
    names = ("orders", "order_items", "payments", "products", "product_category_translation")
    columns = {name: list(RAW_FILES[name].columns) for name in names}
    return {
        "orders": [
            ["o3", "c3", "delivered", "2018-03-28 10:00:00", "", "", "2018-03-30 00:00:00", ""],
            ["solo", "c1", "delivered", "2018-06-03 10:00:00", "", "", "", ""],
        ],
        "order_items": [["o9", "9", "p1", "s1", "2018-05-01 10:00:00", "100.00", "2.00"]],
        "payments": [["o5", "1", "boleto", "1", "1.00"], ["o7", "1", "boleto", "1", "-5.00"]],
        "products": [["p2", "beleza", "5", "9", "1", "100", "", "3", "4"]],
        "product_category_translation": [["jogos", "games"]],
    }, columns


def test_delta_load_refreshes_only_the_days_touched(spark, tmp_path):
    paths = write_csv(tmp_path, raw_rows())
    root = str(tmp_path / "tables")
    first = build.run_all(spark, paths, root, ingested_at="2024-01-01 00:00:00", table_format="log", commit_time="1")
    daily_path = str(tmp_path / "daily")
    category_path = str(tmp_path / "category")
    files.write_parquet(first["daily_sales_gold"].drop("_commit_time"), daily_path, partition="order_date")
    files.write_parquet(first["category_sales_gold"].drop("_commit_time"), category_path, partition="order_purchase_date")
    before = versions.as_of(
        change_log.read_log(spark, f"{root}/silver/orders_silver"), "order_id", "order_purchase_timestamp", "1"
    )

    changed, columns = delta(spark)
    for name, lines in changed.items():
        path = tmp_path / f"delta-{name}.csv"
        with open(path, "w", newline="") as out:
            csv.writer(out).writerows([columns[name], *lines])
        build.load_bronze(
            spark,
            name,
            str(path),
            f"{root}/bronze/{name}_bronze",
            ingested_at="2024-01-02 00:00:00",
            table_format="log",
            mode="append",
            commit_time="2",
        )
    bronze_tables = {
        name: build.open_table(spark, root, name, "log") for name in CONTRACTS if name.endswith("_bronze")
    }
    tables = build.derive(bronze_tables)
    orders, items, payments = (tables[f"{n}_silver"] for n in ("orders", "order_items", "payments"))
    assert items.where("order_id = 'o9'").count() == 1

    ids = spark.createDataFrame([("o3",), ("o9",), ("o5",), ("o7",), ("solo",)], "order_id string")
    dates = refresh.affected_dates(ids, before, orders)
    assert dates.count() == 7
    daily = refresh.refresh_daily_sales(orders, items, payments, dates)
    refresh.swap_dates(daily, dates, daily_path, "order_date")
    renamed = versions.version_diff(
        first["products_silver"], tables["products_silver"], "product_id", ["product_category_name_english"]
    ).where("change_type <> 'unchanged'")
    dates = refresh.affected_dates(ids.union(refresh.orders_of_products(items, renamed)), before, orders)
    category = refresh.refresh_category_sales(items, tables["products_silver"], orders, dates)
    refresh.swap_dates(category, dates, category_path, "order_purchase_date")
    assert not rows(files.read_parquet(spark, category_path).where("gold_key like '2018-06-01%'"), "gold_key")

    full = gold.daily_sales(orders, items, payments)
    assert rows(files.read_parquet(spark, daily_path), *full.columns) == rows(full, *full.columns)
    full = gold.category_sales(items, tables["products_silver"], orders)
    assert rows(files.read_parquet(spark, category_path), *full.columns) == rows(full, *full.columns)

    mart, customers = first["customer_ltv_gold"].drop("_commit_time"), tables["customers_silver"]
    people = refresh.affected_customers(ids, before, orders)
    refreshed = refresh.refresh_customer_ltv(mart, orders, customers, payments, people)
    full = gold.customer_ltv(orders, customers, payments)
    assert rows(refreshed, *full.columns) == rows(full, *full.columns)

    refresh.refresh_silver(spark, root, since="1", commit_time="2")
    for name in [*silver.SILVER, "products_silver"]:
        columns = [c for c in tables[name].columns if c != "_commit_time"]
        assert rows(build.open_table(spark, root, name, "log"), *columns) == rows(tables[name], *columns), name


def test_stream_of_landing_files(spark, tmp_path):
    contract = CONTRACTS["payments_bronze"]
    landing, log, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "checkpoint"))
    schema = "payment_key string, payment_value int, _ingested_at timestamp"

    def land(data):
        spark.createDataFrame(data, "payment_key string, payment_value int, t string").selectExpr(
            "payment_key", "payment_value", "cast(t as timestamp) _ingested_at"
        ).coalesce(1).write.mode("append").parquet(landing)

    def run():
        kind = spark.createDataFrame([], schema).schema
        query = merge_landing_files(spark, landing, log, contract, kind, checkpoint, commit_prefix="20240101")
        query.awaitTermination(120)
        assert query.exception() is None

    land([("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")])
    run()
    land([("a", 2, "2024-01-02"), ("b", 0, "2023-12-31"), ("c", 5, "2024-01-02")])
    run()
    run()
    state = change_log.read_table(spark, log, contract, table_format="log")
    assert rows(state, "payment_key", "payment_value") == [("a", 2), ("b", 1), ("c", 5)]
    assert versions.instants(change_log.read_log(spark, log)).count() == 2


def test_product_feed(spark, tmp_path):
    (tmp_path / "dt=2026-05-01").mkdir()
    (tmp_path / "dt=2026-05-01" / "products.json").write_text(
        '{"product_id":"p1","product_category_name":" Jogos ","product_weight_g":"100"}\n{"product_id":"p2"}\n'
    )
    feed = files.read_product_feed(spark, str(tmp_path))
    assert rows(feed, "product_id", "product_category_name", "product_weight_g", "dt") == [
        ("p1", " Jogos ", "100", "2026-05-01"),
        ("p2", None, None, "2026-05-01"),
    ]


def test_append_adds_and_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4).withColumn("part", F.col("id") % 2)
    files.write_parquet(df, path, partition="part")
    files.write_parquet(df, path, partition="part", mode="append")
    assert files.read_parquet(spark, path).count() == 8
    files.write_parquet(df.where("part = 1"), path, partition="part", replace_touched_only=True)
    assert rows(files.read_parquet(spark, path).groupBy("part").count(), "part", "count") == [(0, 4), (1, 2)]
    files.write_parquet(df.where("part = 1"), path, partition="part")
    assert files.read_parquet(spark, path).count() == 2
