"""Raw files: encodings, quoting, values that cannot be read, keys of raw rows."""

import datetime
from decimal import Decimal

import pytest

from lakemart.contracts import RAW_FILES
from lakemart.operators.dedupe import number_equal_rows
from lakemart.plans import bronze
from lakemart.sources.files import read_csv, read_raw
from tests.compare import missing_last, rows


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_byte_order_mark_and_line_ends(spark, tmp_path):
    text = "product_category_name,product_category_name_english\r\n Beleza_Saude , Health_Beauty\r\nx,y"
    path = write(tmp_path / "t.csv", text, "utf-8-sig")
    got = bronze.category_translation(read_raw(spark, "product_category_translation", path))
    assert rows(got, *got.columns) == [("beleza_saude", "health_beauty"), ("x", "y")]


def test_line_breaks_and_quotes_inside_a_review(spark, tmp_path):
    header = ",".join(RAW_FILES["reviews"].columns)
    text = f'{header}\nr1,o1,5,"Muito ""bom""","linha 1\nlinha 2",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
    got = bronze.reviews(read_raw(spark, "reviews", write(tmp_path / "r.csv", text))).collect()
    assert len(got) == 1
    assert got[0].review_comment_title == 'Muito "bom"'
    assert got[0].review_comment_message == "linha 1\nlinha 2"
    assert got[0].review_score == 5
    assert got[0].review_answer_timestamp == datetime.datetime(2018, 1, 18, 21, 46, 59)
    assert got[0].bronze_record_key.startswith("r1_o1_")


def test_values_that_cannot_be_read_are_null_and_counted(spark, tmp_path):
    header = ",".join(RAW_FILES["order_items"].columns)
    text = (
        f"{header}\n"
        "o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\n"
        "o2,x,p1,s1,not a date,abc,13.291\n"
        ",2,p1,s1,2017-09-19,1.005,\n"
        "o4, 3.7 ,p1,s1,2017-09-19 09:45:35,99999999999.99,0\n"
    )
    raw = read_raw(spark, "order_items", write(tmp_path / "i.csv", text))
    got = {(r.order_id, r.order_item_id): r for r in bronze.order_items(raw).collect()}
    assert got["o1", 1].price == Decimal("58.90") and got["o1", 1].dt == datetime.date(2017, 9, 19)
    assert got["o1", 1].order_item_key == "o1_1"
    bad = got["o2", None]
    assert (bad.price, bad.shipping_limit_date, bad.dt, bad.order_item_key) == (None, None, None, None)
    assert bad.freight_value == Decimal("13.29")
    assert got[None, 2].order_item_key is None and got[None, 2].price == Decimal("1.01")
    assert got["o4", 3].price is None
    rejected = dict(rows(bronze.rejected_values(raw, "order_items"), "column_name", "rejected"))
    assert rejected == {"order_item_id": 1, "shipping_limit_date": 1, "price": 2, "freight_value": 0}


def test_leading_zeros_and_letter_case(spark):
    raw = spark.createDataFrame(
        [("c1", "u1", "01037", " sao paulo ", " sp ")], list(RAW_FILES["customers"].columns)
    )
    assert rows(bronze.customers(raw), *RAW_FILES["customers"].columns) == [
        ("c1", "u1", "01037", "Sao Paulo", "SP")
    ]


def test_header_must_name_the_columns(spark, tmp_path):
    path = write(tmp_path / "s.csv", "seller_id,seller_city\n1,x\n")
    with pytest.raises(Exception):
        read_raw(spark, "sellers", path).collect()
    with pytest.raises(ValueError, match="seller_state"):
        bronze.sellers(read_csv(spark, path))


def test_record_keys_do_not_depend_on_partitions(spark):
    columns = list(RAW_FILES["geolocation"].columns)
    data = [("01037", "-23.5", "-46.6", "sao paulo", "SP")] * 3 + [("01037", "-23.5", "-46.6", "são paulo", "SP")]
    one = bronze.geolocation(spark.createDataFrame(data, columns).coalesce(1))
    many = bronze.geolocation(spark.createDataFrame(data[::-1], columns).repartition(4))
    assert rows(one, *one.columns) == rows(many, *one.columns)
    assert one.select("bronze_record_key").distinct().count() == 4
    assert rows(one.select("geolocation_key").distinct(), "geolocation_key") == [("01037_-23.5_-46.6",)]


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_equal_rows_are_numbered_in_chunks(spark, chunk):
    data = [("a", None)] * 20 + [("b", 1)] * 3 + [(None, None)] * 7 + [("c", 2)]
    numbered = number_equal_rows(spark.createDataFrame(data, "k string, v int"), "n", chunk=chunk)
    expected, seen = [], {}
    for row in data:
        seen[row] = seen.get(row, 0) + 1
        expected.append((*row, seen[row]))
    assert rows(numbered, "k", "v", "n") == sorted(expected, key=missing_last)


def test_days_are_those_of_the_text_in_any_time_zone(spark):
    raw = spark.createDataFrame(
        [("o1", "c1", "x", "2018-01-01 23:30:00", None, None, None, None)],
        ", ".join(f"{name} string" for name in RAW_FILES["orders"].columns),
    )
    name, before = "spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Ho_Chi_Minh", "America/Sao_Paulo"):
            spark.conf.set(name, zone)
            got = bronze.orders(raw).selectExpr("dt", "date_format(order_purchase_timestamp, 'yyyy-MM-dd HH:mm') t")
            assert rows(got, "dt", "t") == [(datetime.date(2018, 1, 1), "2018-01-01 23:30")]
    finally:
        spark.conf.set(name, before)


def test_ingestion_metadata(spark):
    df = bronze.add_ingestion_metadata(
        spark.range(1), batch_id="b7", source_file="f.csv", source_system="shop", ingested_at="2024-05-01 10:00:00"
    )
    row = df.first()
    assert row[1:] == (datetime.datetime(2024, 5, 1, 10), "b7", "f.csv", "shop")
    assert bronze.add_ingestion_metadata(spark.range(1)).first()["_ingested_at"] is not None
