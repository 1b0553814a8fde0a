"""Versioned tables: a worked example in two commits, and the laws the operators keep."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.contracts import CONTRACTS, TableContract
from lakemart.operators import versions
from lakemart.sources import change_log
from tests.compare import rows

CONTRACT = CONTRACTS["payments_bronze"]
# Instants, keys and amounts of the published example.
FIRST, SECOND = "20260503162044236", "20260503162105779"
UPDATED, INSERTED = "a9810da82917af2d9aefd1278f1dcfa0_1", "demo_order_001_1"
SCHEMA = (
    "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(12,2), payment_key string, _ingested_at timestamp"
)


@pytest.fixture()
def seed(spark):
    keys = ["b81ef226f3fe1789b1e8b2acac839d17_1", UPDATED, "25e8ea4e93396b6fa0d3dd708e76c1bd_1", "other_1"]
    data = [(k[:-2], 1, "credit_card", 1, Decimal("24.39"), k) for k in keys]
    df = spark.createDataFrame(data, SCHEMA.rsplit(",", 1)[0]).selectExpr("*", "timestamp'2026-05-03 09:00:00' _ingested_at")
    return versions.seed_subset(df, "payment_key", keys[:3])


@pytest.fixture()
def log_path(spark, seed, tmp_path):
    import datetime

    path = str(tmp_path / "log")
    change_log.overwrite_log(seed, path, CONTRACT, FIRST)
    now = datetime.datetime(2026, 5, 3, 10)
    patch = versions.patch_frame(
        change_log.read_log(spark, path),
        [
            {
                "order_id": UPDATED[:-2],
                "payment_sequential": 1,
                "payment_type": "credit_card",
                "payment_installments": 6,
                "payment_value": Decimal("30.00"),
                "payment_key": UPDATED,
                "_ingested_at": now,
            },
            {
                "order_id": "demo_order_001",
                "payment_sequential": 1,
                "payment_type": "voucher",
                "payment_installments": 1,
                "payment_value": Decimal("49.90"),
                "payment_key": INSERTED,
                "_ingested_at": now,
            },
        ],
    )
    change_log.append_commit(patch, path, CONTRACT, SECOND)
    return path


def read(spark, path, as_of=None):
    return change_log.read_table(spark, path, CONTRACT, table_format="log", as_of=as_of)


def test_two_commits(spark, log_path):
    log = change_log.read_log(spark, log_path)
    assert [r[0] for r in versions.instants(log).collect()] == [FIRST, SECOND]
    assert versions.latest_instant(log) == SECOND and versions.previous_instant(log) == FIRST
    assert versions.select_instant(log) == SECOND
    assert versions.select_instant(log, FIRST) == FIRST
    assert versions.select_instant(log, use_previous=True) == FIRST

    before, after = read(spark, log_path, FIRST), read(spark, log_path, SECOND)
    assert (before.count(), after.count()) == (3, 4)
    value = ("payment_value", "payment_installments")
    assert rows(before.where(f"payment_key = '{UPDATED}'"), *value) == [(Decimal("24.39"), 1)]
    assert rows(after.where(f"payment_key = '{UPDATED}'"), *value) == [(Decimal("30.00"), 6)]
    assert not versions.key_visible(before, "payment_key", INSERTED)
    assert versions.key_visible(after, "payment_key", INSERTED)
    assert rows(read(spark, log_path), *after.columns) == rows(after, *after.columns)

    diff = versions.version_diff(before, after, "payment_key", ["payment_value"])
    changed = rows(diff.where("change_type <> 'unchanged'"), "payment_key", "change_type", "payment_value_before", "payment_value_after")
    assert changed == [
        (UPDATED, "updated", Decimal("24.39"), Decimal("30.00")),
        (INSERTED, "inserted", None, Decimal("49.90")),
    ]
    gone = versions.version_diff(after, before, "payment_key", ["payment_value"])
    assert rows(gone.where("change_type = 'deleted'"), "payment_key") == [(INSERTED,)]


def test_overwrite_starts_anew(spark, log_path, seed):
    change_log.overwrite_log(seed, log_path, CONTRACT, "20260504000000000")
    assert rows(versions.instants(change_log.read_log(spark, log_path)), "_commit_time") == [("20260504000000000",)]


def test_writing_a_commit_again_replaces_it(spark, log_path, seed):
    for _ in range(2):
        change_log.append_commit(seed.limit(1), log_path, CONTRACT, "20260505000000000")
    log = change_log.read_log(spark, log_path)
    assert log.where("_commit_time = '20260505000000000'").count() == 1 and log.count() == 6


def test_new_and_missing_columns(spark, log_path, seed):
    wider = seed.drop("payment_type").selectExpr("*", "'x' as channel")
    change_log.append_commit(wider, log_path, CONTRACT, "20260506000000000")
    state = read(spark, log_path)
    assert "channel" in state.columns and "payment_type" in state.columns
    assert state.where(f"payment_key = '{INSERTED}' and channel is null and payment_type = 'voucher'").count() == 1
    with pytest.raises(TypeError, match="payment_value"):
        bad = seed.selectExpr("* except(payment_value)", "'1' as payment_value")
        change_log.append_commit(bad, log_path, CONTRACT, "20260507000000000")


def test_change_log_reads_only_the_commits_asked_for(spark, log_path):
    log = change_log.read_log(spark, log_path)
    plan = versions.as_of(log, "payment_key", "_ingested_at", FIRST)._jdf.queryExecution().executedPlan().toString()
    assert "_commit_time" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(FIRST in file for file in read(spark, log_path, FIRST).inputFiles())
    changes = versions.changes_since(log, "payment_key", "_ingested_at", FIRST)
    assert rows(changes, "payment_key") == [(UPDATED,), (INSERTED,)]
    merged = versions.upsert(read(spark, log_path, FIRST), changes, "payment_key", "_ingested_at")
    assert rows(merged, *merged.columns) == rows(read(spark, log_path), *merged.columns)


def test_one_commit_is_a_plain_scan_and_small_ones_do_not_shuffle_the_base(spark, log_path):
    one = read(spark, log_path, FIRST)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in one and "Window" not in one
    two = read(spark, log_path)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in two and "BroadcastHashJoin" in two


def test_no_visible_commit(spark, log_path):
    assert read(spark, log_path, "1").count() == 0


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_state_equals_the_newest_of_all_versions(spark, tmp_path, threshold):
    """Random commits with late rows, equal and missing orderings and missing keys."""
    rng = random.Random(11)
    contract = TableContract("t", "silver", "k", "o")
    path, everything = str(tmp_path / "log"), []
    for commit in range(5):
        data = [
            (rng.choice([*"abcdefghij", None]), rng.choice([None, 1, 2, 3, 4]), rng.randrange(9)) for _ in range(12)
        ]
        df = spark.createDataFrame(data, "k string, o int, v int")
        change_log.append_commit(df, path, contract, f"c{commit}")
    log = change_log.read_log(spark, path)
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, threshold)
    try:
        for commit in ["c0", "c1", "c3", None]:
            state = change_log.read_state(spark, path, contract, as_of=commit)
            expected = versions.as_of(log, "k", "o", commit)
            assert rows(state, "k", "o", "v", "_commit_time") == rows(expected, "k", "o", "v", "_commit_time")
    finally:
        spark.conf.set(name, before)


def frame(spark, data):
    """Rows as an SQL table, whose size Catalyst knows."""
    values = ", ".join(f"('{k}', {'CAST(NULL AS INT)' if o is None else o}, '{v}')" for k, o, v in data)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(k, o, v)")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_upsert_rules(spark, threshold):
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, threshold)
    try:
        check_upsert_rules(spark, broadcast=threshold != "-1")
    finally:
        spark.conf.set(name, before)


def check_upsert_rules(spark, broadcast):
    current = frame(spark, [("a", 5, "old"), ("b", 5, "old"), ("c", 5, "old"), ("e", None, "old")])
    incoming = frame(
        spark,
        [("a", 6, "newer"), ("b", 5, "same"), ("c", 4, "late"), ("d", 1, "first"), ("d", 2, "second"), ("e", 0, "any")],
    )
    expected = [("a", 6, "newer"), ("b", 5, "same"), ("c", 5, "old"), ("d", 2, "second"), ("e", 0, "any")]
    merged = versions.upsert(current, incoming, "k", "o")
    assert ("Broadcast" in merged._jdf.queryExecution().executedPlan().toString()) == broadcast
    assert rows(merged, "k", "o", "v") == expected
    again = versions.upsert(merged, incoming, "k", "o")
    assert rows(again, "k", "o", "v") == expected
    spread = versions.upsert(current.repartition(5), incoming.repartition(3), "k", "o")
    assert rows(spread, "k", "o", "v") == expected
    wider = versions.upsert(current, incoming.selectExpr("v", "k", "o", "1 as extra"), "k", "o")
    assert wider.columns == ["k", "o", "v", "extra"]
    assert rows(wider, "k", "o", "v") == expected
    assert rows(wider.where("extra is null"), "k") == [("c",)]


def test_deleted_keys_come_back_with_a_newer_row(spark):
    log = spark.createDataFrame(
        [("a", 1, False, "1"), ("a", 2, True, "2"), ("b", 1, None, "1"), ("c", 1, True, "1"), ("c", 2, False, "2")],
        "k string, o int, gone boolean, _commit_time string",
    )
    assert rows(versions.snapshot(log, "k", "o", deleted="gone"), "k") == [("b",), ("c",)]


def test_too_few_commits(spark):
    log = spark.createDataFrame([("a", "1")], "k string, _commit_time string")
    with pytest.raises(ValueError):
        versions.previous_instant(log)
    with pytest.raises(ValueError):
        versions.select_instant(log.limit(0))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_upsert_treats_repeated_keys_alike_at_every_size(spark, threshold):
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, threshold)
    try:
        columns = "k string, o int, v string"
        current = spark.createDataFrame([("a", 5, "x"), ("a", 7, "y"), ("b", 1, "x"), (None, 1, "x")], columns)
        incoming = spark.createDataFrame([("a", 6, "new"), (None, 2, "new")], columns)
        merged = versions.upsert(current, incoming, "k", "o")
        assert rows(merged, "k", "o", "v") == [("a", 6, "new"), ("a", 7, "y"), ("b", 1, "x"), (None, 2, "new")]
    finally:
        spark.conf.set(name, before)


def test_commits_come_from_the_folder_names(spark, tmp_path):
    path = str(tmp_path / "log")
    assert change_log.commits(spark, path) == []
    contract = CONTRACTS["payments_silver"]
    row = spark.sql("select 'a' payment_key, 1 payment_value, timestamp'2024-01-01' _ingested_at")
    change_log.overwrite_log(row, path, contract, "2")
    change_log.append_commit(row.withColumn("payment_value", F.lit(2)), path, contract, "3")
    assert change_log.commits(spark, path) == ["2", "3"]
    change_log.append_commit(row.limit(0), path, contract, "3")  # run again without rows: its old rows go
    assert rows(change_log.read_state(spark, path, contract), "payment_value") == [(1,)]
    change_log.overwrite_log(row.limit(0), path, contract, "4")
    assert change_log.commits(spark, path) == ["4"]
    assert change_log.read_state(spark, path, contract).columns == [*row.columns, "_commit_time"]
    assert change_log.read_state(spark, path, contract).isEmpty()


def test_changes_of_a_derived_table(spark, tmp_path):
    """Only what differs is committed, vanished keys as deletions; a mart may go back in its ordering."""
    path, contract = str(tmp_path / "log"), CONTRACTS["customer_ltv_gold"]

    def state(data):
        return spark.createDataFrame(data, "customer_id string, last_order_date int, order_count int")

    def stored():
        return rows(change_log.read_state(spark, path, contract), "customer_id", "last_order_date", "order_count")

    change_log.append_changes(state([("a", 5, 1), ("b", 5, 1), (None, 1, 1)]), path, contract, "1")
    for _ in range(2):  # the second time is the same commit again
        change_log.append_changes(state([("a", 3, 1), (None, 1, 1), ("c", 1, 1)]), path, contract, "2")
        log = change_log.read_log(spark, path).where("_commit_time = '2'")
        assert sorted((r["customer_id"], r["_deleted"]) for r in log.collect()) == [("a", False), ("b", True), ("c", False)]
        assert stored() == [("a", 3, 1), ("c", 1, 1), (None, 1, 1)]
    change_log.append_changes(state([("b", 9, 9)]), path, contract, "3")
    assert stored() == [("b", 9, 9)]
    assert change_log.read_state(spark, path, contract, as_of="1").count() == 3
