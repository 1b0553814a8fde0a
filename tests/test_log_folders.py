"""Versioned tables in date folders: states, stored bases and the change feed against plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lakemart.contracts import TableContract
from lakemart.operators import versions
from lakemart.sources import change_log

PARTED = TableContract("t", "silver", "k", "at", "day")
WHOLE = TableContract("t", "silver", "k", "at")
SCHEMA = "k string, at int, value int, day date, _deleted boolean"


def day(n):
    return None if n is None else datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def history(seed, n_commits=5):
    """Commits with new, late, moved, tied and deleted rows."""
    draw = random.Random(seed)
    made = []
    for commit in range(1, n_commits + 1):
        rows = {}
        for _ in range(draw.randrange(1, 25)):
            key = None if draw.random() < 0.05 else f"k{draw.randrange(20)}"
            at = None if draw.random() < 0.05 else commit * 2 - draw.randrange(5)
            rows[key] = (key, at, draw.randrange(1000), day(draw.choice([0, 1, 40, 70, None])), draw.random() < 0.15)
        made.append((str(commit), list(rows.values())))
    return made


def brute_states(commits):
    """The rows of each key after every commit; rows that are not older than what is held win."""
    held, states = {}, {}
    for commit, rows in commits:
        for row in rows:
            old = held.get(row[0])
            if old is None or (row[1] is not None, row[1] or 0) >= (old[1] is not None, old[1] or 0):
                held[row[0]] = row
        states[commit] = sorted((r[:4] for r in held.values() if not r[4]), key=str)
    return states


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "at", "value", "day").collect()), key=str)


def write(spark, path, contract, commits, by_month=False):
    for number, (commit, rows) in enumerate(commits):
        df = spark.createDataFrame(rows, SCHEMA)
        if number == 0:
            change_log.overwrite_log(df, path, contract, commit, by_month=by_month)
        else:
            change_log.append_commit(df, path, contract, commit)


@pytest.mark.parametrize(("contract", "by_month", "seed"), [(PARTED, False, 1), (PARTED, True, 2), (WHOLE, False, 1)])
def test_states_are_those_of_a_dictionary(spark, tmp_path, contract, by_month, seed):
    path, commits = str(tmp_path / "log"), history(seed)
    write(spark, path, contract, commits, by_month)
    assert change_log.read_log(spark, path).columns == ["k", "at", "value", "day", "_deleted", "_commit_time"] or not by_month
    states = brute_states(commits)
    for commit, expected in states.items():
        assert rows_of(change_log.read_state(spark, path, contract, as_of=commit)) == expected
    change_log.write_base(spark, path, contract, "3")
    assert change_log.bases(spark, path) == ["3"]
    for commit, expected in states.items():
        assert rows_of(change_log.read_state(spark, path, contract, as_of=commit)) == expected
    with pytest.raises(ValueError):
        change_log.write_base(spark, path, contract, "7")


@pytest.mark.parametrize(
    ("contract", "seed", "since", "until"), [(PARTED, 3, "1", "5"), (PARTED, 4, "2", "4"), (WHOLE, 5, "3", None), (PARTED, 6, "5", None)]
)
def test_the_feed_brings_an_older_state_to_the_newer_one(spark, tmp_path, contract, seed, since, until):
    path, commits = str(tmp_path / "log"), history(seed)
    write(spark, path, contract, commits)
    states = brute_states(commits)
    feed = change_log.change_feed(spark, path, contract, since, until)
    older = change_log.read_state(spark, path, contract, as_of=since).drop(versions.COMMIT)
    assert rows_of(change_log.replay(older, feed, "k")) == states[until or "5"]
    for row in feed.collect():
        before = {r[0]: r for r in states[str(int(row[versions.COMMIT]) - 1)]}.get(row["k"])
        after = {r[0]: r for r in states[row[versions.COMMIT]]}.get(row["k"])
        kind = "insert" if before is None else "delete" if after is None else "update"
        assert row["change_type"] == kind
        assert (row["_before"] and tuple(row["_before"][n] for n in ("k", "at", "value", "day"))) == before
        assert (row["k"], row["at"], row["value"], row["day"]) == (after or before)


def test_a_change_of_one_day_meets_one_day(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(f"k{i}", 1, i, day(i % 10), False) for i in range(100)]
    write(spark, path, PARTED, [("1", rows), ("2", [("k3", 2, 0, day(3), False), ("new", 2, 1, day(3), False)])])
    state = change_log.read_state(spark, path, PARTED)
    plan = state._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "Scan" in line]
    joined = [s for s in scans if "day#" in s and "NOT" not in s.split("PartitionFilters: [")[1].split("]")[0]]
    assert any("2024-01-04" in s or "19726" in s for s in joined) and any("NOT" in s for s in scans)
    before = spark.read.schema(SCHEMA).parquet(f"{path}/_commit_time=1")
    assert before.where("day = '2024-01-04'").count() == 10 and state.count() == 101
    one_day = state.where("day = '2024-01-09'")._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-09" in one_day or "19731" in one_day


def test_a_commit_without_rows_keeps_its_folder_and_schema(spark, tmp_path):
    path = str(tmp_path / "log")
    nothing = spark.createDataFrame([], SCHEMA)
    change_log.overwrite_log(nothing, path, PARTED, "1")
    change_log.append_commit(nothing, path, PARTED, "2")
    assert change_log.commits(spark, path) == ["1", "2"]
    change_log.append_commit(spark.createDataFrame([("a", 1, 1, day(0), False)], SCHEMA), path, PARTED, "3")
    assert rows_of(change_log.read_state(spark, path, PARTED)) == [("a", 1, 1, day(0))]


def test_sifting_leaves_only_candidates_in_the_shuffle(spark):
    base = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("at"), F.lit(0).alias("value"))
    base = base.unionByName(spark.createDataFrame([(None, 1, 0)], "k string, at int, value int"))
    change = spark.createDataFrame([(str(i), 2, 7) for i in range(0, 300, 3)] + [(None, 2, 7), ("new", 2, 7)], "k string, at int, value int")
    marked = versions.sifted(base, change, ["k"])
    maybe = marked.where("_maybe")
    assert maybe.join(change.select("k"), maybe["k"].eqNullSafe(change["k"])).count() == 101
    assert maybe.count() < 200
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = versions.upsert(base, change, "k", "at", sift=True)
        plain = versions.upsert(base, change, "k", "at")
        assert sorted(map(str, merged.collect())) == sorted(map(str, plain.collect()))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "_maybe" in plan or "bitwise" in plan.lower() or "&" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
