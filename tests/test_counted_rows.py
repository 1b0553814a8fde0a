"""Row counts on stored tables of the columns they need."""

from lakemart.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def test_row_counts_store_the_columns_they_read_and_count_right(spark, monkeypatch):
    kept = {}
    plain = catalog.stored
    monkeypatch.setattr(catalog, "stored", lambda df, name: kept.update({name: tuple(df.columns)}) or plain(df, name))
    found = catalog.check_row_counts(spark, FOLDER).collect()
    assert {name: kept[name] for name in catalog.FACTS} == {
        "orders_silver": ("order_id", "customer_id", "order_purchase_date"),
        "order_items_silver": ("order_id", "order_item_key", "product_id", "seller_id", "price", "freight_value"),
        "payments_silver": ("order_id", "payment_value"),
    }
    assert len(found) == 22 and all(row.passed for row in found)
