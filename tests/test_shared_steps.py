"""Steps that versioned builds and refreshes share: what is moved, and that the results stay."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS, TableContract
from lakemart.operators import versions
from lakemart.plans import silver
from lakemart.sources import change_log

PARTED = TableContract("t", "silver", "k", "at", "day")
SCHEMA = "k string, at int, value int, day date"


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def two_commits(spark, path):
    """A row that moves, a late one of another day, a new one, one that stays and a missing key."""
    first = [("a", 1, 1, day(0)), ("b", 5, 2, day(0)), ("c", 1, 3, day(1)), (None, 1, 4, day(1))]
    later = [("a", 2, 10, day(40)), ("b", 4, 20, day(40)), ("d", 1, 30, day(0)), (None, 2, 40, day(1))]
    change_log.overwrite_log(spark.createDataFrame(first, SCHEMA), path, PARTED, "1")
    change_log.append_commit(spark.createDataFrame(later, SCHEMA), path, PARTED, "2")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_commit_are_worked_out_once(spark, tmp_path, monkeypatch):
    kept = []
    plain = change_log.stored
    monkeypatch.setattr(change_log, "stored", lambda df, name: kept.append(name) or plain(df, name))
    path = str(tmp_path / "t")
    two_commits(spark, path)
    assert kept == ["commit_rows", "commit_moves"]
    found = {r["k"]: r["value"] for r in change_log.read_state(spark, path, PARTED).collect()}
    assert found == {"a": 10, "b": 2, "c": 3, "d": 30, None: 40}


def test_a_single_later_commit_is_not_deduped_again(spark, tmp_path, shuffled):
    path = str(tmp_path / "t")
    two_commits(spark, path)
    assert "Window" not in plan(change_log.read_state(spark, path, PARTED))


def test_a_feed_shuffles_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    two_commits(spark, path)
    feed = change_log.change_feed(spark, path, PARTED, since="1")
    assert plan(feed).count("Exchange hashpartitioning(_key") == 1
    found = {r["k"]: (r["change_type"], r["value"]) for r in feed.collect()}
    assert found == {"a": ("update", 10), "d": ("insert", 30), None: ("update", 40)}


def test_silver_of_keyed_rows_needs_no_window(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [("p1", "o1", 1, " Card", 0, 5, at), ("p2", "o1", 2, "cash ", 2, -5, at), (None, None, 1, None, None, None, at)]
    schema = "payment_key string, order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value int"
    bronze = spark.createDataFrame(rows, f"{schema}, _ingested_at timestamp")
    keyed = silver.make("payments_silver", bronze, keyed=True)
    assert "Window" not in plan(keyed)
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, silver.payments(bronze).collect()))
    # The key of a translation is normalised in silver, so two bronze keys may be one there.
    words = spark.createDataFrame([(" A", "x", at), ("a", "x", at)], "product_category_name string, product_category_name_english string, _ingested_at timestamp")
    assert silver.make("product_category_translation_silver", words, keyed=True).count() == 1


def test_tables_of_the_same_key_name_it_so():
    for name in silver.SAME_KEY:
        assert CONTRACTS[name].key == CONTRACTS[silver.SILVER[name][1]].key


def test_a_keyed_commit_equals_the_deduped_one(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 1, day(0)), ("b", 5, 2, day(40))], SCHEMA)
    states = []
    for keyed in (True, False):
        path = str(tmp_path / f"{keyed}")
        change_log.overwrite_log(rows, path, PARTED, "1", keyed=keyed)
        change_log.append_commit(versions.deletions(rows.where("k = 'a'")), path, PARTED, "2", keyed=keyed)
        states.append([tuple(r) for r in change_log.read_state(spark, path, PARTED).orderBy(F.col("k")).select(*rows.columns).collect()])
    assert states[0] == states[1] == [("b", 5, 2, day(40))]
