"""Versioned tables as DataFrame operators over a change log.

A change log holds every version of every row with its ``_commit_time``, a text that sorts by time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators.dedupe import latest_per_key

COMMIT = "_commit_time"
DELETED = "_deleted"


def newest_in_batch(incoming: DataFrame, key: str, ordering: str) -> DataFrame:
    """Of several incoming rows with one key the one with the greatest ordering value."""
    return latest_per_key(incoming, key, ordering)


def reconcile_schema(df: DataFrame, target: StructType) -> DataFrame:
    """``df`` in the column order of ``target``: missing columns become NULL, new ones come last.

    A column whose type differs from the table's is an error.
    """
    changed = [
        f"{field.name}: {df.schema[field.name].dataType.simpleString()} is not {field.dataType.simpleString()}"
        for field in target.fields
        if field.name in df.columns and df.schema[field.name].dataType != field.dataType
    ]
    if changed:
        raise TypeError("column types differ: " + "; ".join(changed))
    known = [
        F.col(field.name) if field.name in df.columns else F.lit(None).cast(field.dataType).alias(field.name)
        for field in target.fields
    ]
    names = set(target.fieldNames())
    return df.select(*known, *[name for name in df.columns if name not in names])


def upsert(current: DataFrame, incoming: DataFrame, key: str, ordering: str, *, sift: bool = False) -> DataFrame:
    """``current`` with ``incoming`` merged by key: new keys inserted, newer versions replace older ones.

    On equal ordering values the incoming row wins. ``current`` holds every key once, over the whole
    table; Catalyst does not shuffle it while ``incoming`` is within the broadcast threshold. Beyond that,
    ``sift`` keeps the rows of ``current`` whose keys surely do not change out of the shuffle.
    """
    rows = reconcile_schema(incoming, current.schema)
    table = reconcile_schema(current, rows.schema)
    return _lay_over(table, newest_in_batch(rows, key, ordering), [key], ordering, sift=sift)


# A sieve of keys: words of 64 bits, of which a key sets BITS_SET in one. The words fit a broadcast.
MOST_WORDS = 1 << 20  # 16 MB of numbers at most; a change of more than some 16 million keys passes nearly all
BITS_SET = 3


def _word_and_bits(key: Sequence[str]) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(F.lit("word"), *key), F.lit(MOST_WORDS)).cast("int")
    draw = F.xxhash64(F.lit("bits"), *key)
    bits = F.lit(0).cast("long")
    for turn in range(BITS_SET):
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(draw, 6 * turn).bitwiseAND(63).cast("int"))
        bits = bits.bitwiseOR(one)
    return place, bits


def sifted(rows: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` with ``_maybe``: false only for rows whose key is surely not in ``keys``, NULL keys included.

    A Bloom filter of ``keys``, one word a key: it is at most ``MOST_WORDS`` rows at any size of ``keys``, so its
    broadcast is bounded, and ``rows`` stay where they are.
    """
    place, bits = _word_and_bits(key)
    words = keys.select(place.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    own = rows.withColumn("_place", place).withColumn("_own", bits)
    met = own.join(F.broadcast(words), F.col("_place") == F.col("_word"), "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own"), F.lit(False))
    return met.withColumn("_maybe", maybe).drop("_place", "_own", "_word", "_bits")


def of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys``; the others are sifted out where they are, before any shuffle."""
    near = sifted(rows, keys, [key]).where("_maybe").drop("_maybe")
    return near.join(keys.select(F.col(key).alias("_wanted")), F.col(key).eqNullSafe(F.col("_wanted")), "left_semi")


def _lay_over(
    base: DataFrame, newest: DataFrame, key: Sequence[str], ordering: str, *, sift: bool = False
) -> DataFrame:
    """``base`` with the rows of ``newest`` in place of its own where they are not older, and the new keys.

    Both hold every key once and have the same columns. ``base`` is read once for its rows and once
    for the keys that are known; how the joins run is left to Catalyst. The columns of the key stay those of
    ``base``, so a filter on them reaches its scan.
    """
    if sift:
        marked = sifted(base, newest, key)
        beside = marked.where(~F.col("_maybe")).drop("_maybe")
        near = marked.where("_maybe").drop("_maybe")
        return beside.unionByName(_lay_over(near, newest, key, ordering))
    theirs = [F.col(name).alias(f"_key{i}") for i, name in enumerate(key)]
    # Column by column, so that only those a reader asks for are shuffled.
    new = {name: f"_new_{name}" for name in newest.columns}
    change = newest.select(*theirs, F.lit(True).alias("_met"), *[F.col(name).alias(alias) for name, alias in new.items()])
    same_key = F.lit(True)
    for i, name in enumerate(key):
        same_key = same_key & F.col(name).eqNullSafe(F.col(f"_key{i}"))
    # Orderings compare with NULL last; on equal ones the row of the change wins.
    newer = F.coalesce(F.col(new[ordering]) >= F.col(ordering), F.col(ordering).isNull())
    wins = F.col("_met").isNotNull() & newer
    columns = [
        F.col(name) if name in key else F.when(wins, F.col(new[name])).otherwise(F.col(name)).alias(name)
        for name in newest.columns
    ]
    current = base.join(change, same_key, "left").select(*columns)

    # No more rows than the change has.
    keys = change.select(*[f"_key{i}" for i in range(len(key))])
    known = base.select(*key).join(keys, same_key, "left_semi").select(*theirs)
    return current.unionByName(newest.join(known, same_key, "left_anti"))


def as_of(log: DataFrame, key: str | Sequence[str], ordering: str, commit_time: str | None = None) -> DataFrame:
    """The state of the table after ``commit_time`` (the latest commit by default).

    The commit filter prunes folders of the log. Equal ordering values: the later commit wins.
    """
    visible = log if commit_time is None else log.where(F.col(COMMIT) <= commit_time)
    return latest_per_key(visible, key, _by_commit(log, ordering))


def _by_commit(log: DataFrame, ordering: str) -> list[str | Column]:
    """Newest first. Within a commit a row goes before a deletion: that is where its key came from."""
    deleted = [F.asc_nulls_first(DELETED)] if DELETED in log.columns else []
    return [ordering, *([] if ordering == COMMIT else [COMMIT]), *deleted]


def overlay(
    base: DataFrame, later: DataFrame, key: str | Sequence[str], ordering: str, *, sift: bool = False, keyed: bool = False
) -> DataFrame:
    """The state after the commits of ``later``, on top of ``base``, which holds every key once.

    The result is that of ``as_of`` over both. ``keyed`` tells that ``later`` holds every key once as well.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return _lay_over(base, later if keyed else as_of(later, keys, ordering), keys, ordering, sift=sift)


def snapshot(log: DataFrame, key: str, ordering: str, *, deleted: str = DELETED) -> DataFrame:
    """The latest state, without the keys whose newest row is flagged as deleted."""
    return without_deleted(as_of(log, key, ordering), deleted)


def without_deleted(state: DataFrame, deleted: str = DELETED) -> DataFrame:
    """The rows not flagged in the column ``deleted``, without that column; all rows where it is missing."""
    if deleted not in state.columns:
        return state
    return state.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def deletions(rows: DataFrame) -> DataFrame:
    """``rows`` as a change that deletes their keys, unless a newer version of a key follows."""
    return rows.withColumn(DELETED, F.lit(True))


def instants(log: DataFrame) -> DataFrame:
    """The commits of the table, oldest first; commits whose rows were all replaced are listed too."""
    return log.select(COMMIT).distinct().orderBy(COMMIT)


def latest_instant(log: DataFrame) -> str | None:
    return log.agg(F.max(COMMIT)).first()[0]


def newest_instants(log: DataFrame, n: int) -> DataFrame:
    """The last ``n`` commits, newest first."""
    return log.select(COMMIT).distinct().orderBy(F.desc(COMMIT)).limit(n)


def previous_instant(log: DataFrame) -> str:
    """The commit before the latest one."""
    last_two = [row[0] for row in newest_instants(log, 2).collect()]
    if len(last_two) < 2:
        raise ValueError("the table has fewer than two commits")
    return min(last_two)


def select_instant(log: DataFrame, instant: str | None = None, *, use_previous: bool = False) -> str:
    """The commit to read: the previous one if asked for, else the one given, else the latest."""
    if use_previous:
        return previous_instant(log)
    chosen = instant or latest_instant(log)
    if chosen is None:
        raise ValueError("the table has no commits")
    return chosen


def changes_since(log: DataFrame, key: str, ordering: str, commit_time: str) -> DataFrame:
    """The newest version of every key committed after ``commit_time``.

    Only the folders of later commits are read. Merging the result with ``upsert`` brings an older
    copy of the table to the latest state.
    """
    return latest_per_key(log.where(F.col(COMMIT) > commit_time), key, _by_commit(log, ordering))


def version_diff(before: DataFrame, after: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """One row per key with ``change_type`` and each column's value before and after."""
    names = list(columns)
    old = before.select(key, *[F.col(n).alias(f"{n}_before") for n in names], F.lit(True).alias("_old"))
    new = after.select(key, *[F.col(n).alias(f"{n}_after") for n in names], F.lit(True).alias("_new"))
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"{name}_before").eqNullSafe(F.col(f"{name}_after"))
    change = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "deleted")
        .when(same, "unchanged")
        .otherwise("updated")
    )
    joined = old.join(new, key, "full")
    sides = [f"{name}_{side}" for name in names for side in ("before", "after")]
    return joined.select(key, change.alias("change_type"), *sides)


def key_visible(state: DataFrame, key: str, value: object) -> bool:
    """Whether the state holds a row with this key."""
    return not state.where(F.col(key) == value).limit(1).isEmpty()


def seed_subset(source: DataFrame, key: str, values: Iterable[object]) -> DataFrame:
    """The rows of a few listed keys; use a semi-join for a long list."""
    return source.where(F.col(key).isin(list(values)))


def patch_frame(target: DataFrame, rows: Iterable[Mapping[str, object]]) -> DataFrame:
    """A few hand-written rows with the columns, order and types of ``target``."""
    schema = target.drop(COMMIT).schema
    ordered = [tuple(row.get(name) for name in schema.fieldNames()) for row in rows]
    return target.sparkSession.createDataFrame(ordered, schema)
