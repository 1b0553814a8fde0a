"""What builds and refreshes leave on disk, and that their results stay."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.session import lean, shared_folder, stored
from lakemart.sources import change_log
from tests.compare import rows
from tests.test_shared_steps import PARTED, SCHEMA, day, plan, two_commits


def temporaries(spark, name):
    return set(Path(shared_folder(spark), "lakemart").glob(f"{name}-*"))


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return manager.getAllFiles().mkString("\n").count("shuffle_")


def codecs(path):
    return {p.name.split(".")[-2] for p in Path(path).rglob("*.parquet") if not p.name.startswith(("_", "."))}


def test_a_job_leaves_its_results_only(spark, tmp_path):
    before, codec = shuffle_files(spark), spark.conf.get("spark.sql.parquet.compression.codec")
    with lean(spark):
        grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count()
        kept = stored(grouped.repartition(3), "only_inside")
        assert len(temporaries(spark, "only_inside")) == 1
        kept.write.parquet(str(tmp_path / "t"))
        assert shuffle_files(spark) <= before
    assert not temporaries(spark, "only_inside")
    assert codecs(tmp_path / "t") == {"zstd"}
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_a_failed_job_restores_the_session(spark):
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    with pytest.raises(ValueError, match="stop"), lean(spark):
        stored(spark.range(3), "only_inside")
        raise ValueError("stop")
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec and not temporaries(spark, "only_inside")
    outside = stored(spark.range(3), "outside")
    assert outside.count() == 3 and temporaries(spark, "outside")


def test_a_commit_leaves_no_temporary_tables(spark, tmp_path):
    before = temporaries(spark, "commit_rows") | temporaries(spark, "commit_moves")
    two_commits(spark, str(tmp_path / "t"))
    assert temporaries(spark, "commit_rows") | temporaries(spark, "commit_moves") == before
    assert codecs(tmp_path / "t") == {"zstd"}
    found = {r["k"]: r["value"] for r in change_log.read_state(spark, str(tmp_path / "t"), PARTED).collect()}
    assert found == {"a": 10, "b": 2, "c": 3, "d": 30, None: 40}


def test_a_state_moves_only_the_columns_asked_for(spark, tmp_path):
    path = str(tmp_path / "t")
    two_commits(spark, path)
    found = change_log.read_state(spark, path, PARTED).select("k", "day")
    read = re.findall("ReadSchema: struct<[^>]*>", plan(found))
    assert read and not [schema for schema in read if "value" in schema]
    assert {(r["k"], r["day"]) for r in found.collect()} == {("a", day(40)), ("b", day(0)), ("c", day(1)), ("d", day(0)), (None, day(1))}


def test_rows_of_a_commit_need_no_dedupe(spark, tmp_path):
    path = str(tmp_path / "t")
    two_commits(spark, path)
    found = change_log.rows_of_commit(spark, path, PARTED, "2")
    assert "Window" not in plan(found)
    assert {(r["k"], r["value"], bool(r["_deleted"])) for r in found.collect()} == {("a", 10, False), ("d", 30, False), (None, 40, False)}
    # A key that is deleted in another folder than its own leaves two deletions, which are one.
    gone = spark.createDataFrame([("c", 2, 3, day(50))], SCHEMA).withColumn("_deleted", F.lit(True))
    change_log.append_commit(gone, path, PARTED, "3")
    found = change_log.rows_of_commit(spark, path, PARTED, "3").collect()
    assert [(r["k"], r["at"], r["_deleted"]) for r in found] == [("c", 2, True)]


def test_placed_rows_are_committed_as_others(spark, tmp_path):
    source = str(tmp_path / "source")
    two_commits(spark, source)
    states = []
    for placed in (True, False):
        path = str(tmp_path / f"{placed}")
        first = change_log.read_state(spark, source, PARTED, as_of="1").drop("_commit_time")
        change_log.overwrite_log(first, path, PARTED, "1", keyed=True, placed=placed)
        change_log.append_commit(change_log.rows_of_commit(spark, source, PARTED, "2"), path, PARTED, "2", keyed=True, placed=placed)
        late = spark.createDataFrame([("a", 1, 99, day(3)), ("d", 1, 31, day(70))], SCHEMA)
        change_log.append_commit(late, path, PARTED, "3", keyed=True, placed=placed)
        states.append(rows(change_log.read_state(spark, path, PARTED), "k", "value", "day"))
    assert states[0] == states[1] and len(states[0]) == 5


def test_a_feed_of_one_column_tells_the_same_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    two_commits(spark, path)
    # One row as it was, one whose value goes missing, one deleted and a late one.
    again = [("a", 2, 10, day(40), False), ("c", 1, None, day(1), False), ("d", 1, 30, day(0), True), ("b", 3, 8, day(0), False)]
    change_log.append_commit(spark.createDataFrame(again, f"{SCHEMA}, _deleted boolean"), path, PARTED, "3", keyed=True)
    whole = change_log.change_feed(spark, path, PARTED, since="1")
    narrow = change_log.change_feed(spark, path, PARTED, since="1", only=["k"])
    columns = ("_commit_time", "change_type", "k")
    assert rows(narrow, *columns) == rows(whole, *columns) and len(rows(whole, *columns)) == 5
    assert "value" not in "".join(re.findall("Exchange .*", plan(narrow)))
