"""Change logs: reading a range, collapsing it, applying it to a table, producing it.

A change row carries the columns of the table plus ``__$start_lsn``,
``__$seqval`` and ``__$operation`` (1 delete, 2 insert, 3 row before an update,
4 row after it). (lsn, seqval, operation) orders the changes of a key.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.lsn import merge_predicate_text
from tidemark.operators.running import HOT_ROWS, with_group_stats
from tidemark.session import ensure_checkpoint_dir

LSN = "__$start_lsn"
SEQ = "__$seqval"
OP = "__$operation"
META_PREFIX = "__$"
LOG_FILE, LOG_FILE_CHARS = "log_file", len("0x") + 8

DELETE, INSERT, BEFORE, AFTER = 1, 2, 3, 4
BROADCAST_BYTES = 256 * 1024 * 1024


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def order_columns() -> list[Column]:
    return [_q(LSN), _q(SEQ), _q(OP)]


def _check_keys(keys: Sequence[str], *frames: DataFrame) -> list[str]:
    if not keys:
        raise ValueError("No primary key columns found")
    missing = [k for k in keys if any(k not in f.columns for f in frames)]
    if missing:
        raise ValueError(f"Missing primary key columns: {missing}")
    return list(keys)


def lsn_text(lsn: str) -> str:
    """A bound as the log writes it: 0x and 20 upper-case hexadecimal digits."""
    if not re.fullmatch("0[xX][0-9A-Fa-f]{20}", lsn):
        raise ValueError(f"not an LSN: {lsn!r}")
    return "0x" + lsn[2:].upper()


def read_changes(log: DataFrame, from_lsn: str, to_lsn: str, *, row_filter: str = "all",
                 after: bool = False, min_lsn: str | None = None) -> DataFrame:
    """Changes of an LSN range; both ends belong to it unless ``after`` skips the first.

    The comparison is on the stored text, which is fixed width, so it reaches the
    parquet scan as a pushed filter and prunes by row group statistics; a log stored
    by :func:`write_changes` is pruned to the folders of the range first.
    ``row_filter='all update old'`` keeps the rows before updates.
    """
    if min_lsn is not None and lsn_text(from_lsn) < lsn_text(min_lsn):
        raise ValueError(f"from_lsn {from_lsn} is older than the change log (starts at {min_lsn})")
    from_lsn, to_lsn = lsn_text(from_lsn), lsn_text(to_lsn)
    lower = _q(LSN) > from_lsn if after else _q(LSN) >= from_lsn
    rows = log.filter(lower & (_q(LSN) <= to_lsn))
    if LOG_FILE in log.columns:
        rows = rows.filter(F.col(LOG_FILE).between(from_lsn[:LOG_FILE_CHARS], to_lsn[:LOG_FILE_CHARS])).drop(LOG_FILE)
    return rows if row_filter == "all update old" else rows.filter(_q(OP) != BEFORE)


def write_changes(changes: DataFrame, path: str) -> None:
    """Append changes to a stored log, one folder per log file of the source (the first
    four bytes of the LSN)."""
    stored = changes.withColumn(LOG_FILE, F.substring(_q(LSN), 1, LOG_FILE_CHARS))
    stored.write.mode("append").partitionBy(LOG_FILE).parquet(path)


def strip_meta(changes: DataFrame) -> DataFrame:
    """Only the columns of the table."""
    return changes.select(*[_q(c) for c in changes.columns if not c.startswith(META_PREFIX)])


def split_ops(changes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deletes, inserts and updates."""
    return tuple(changes.filter(_q(OP) == op) for op in (DELETE, INSERT, AFTER))


def latest_change(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last change per key.

    The rank filter is planned as a group limit below the shuffle as well, so a
    hot key leaves each map task as one row.
    """
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order_columns()])
    return changes.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def net_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """At most one row per key for a whole range.

    insert .. delete gives nothing, insert .. update an insert, delete .. insert an
    update, anything else the last operation. First and last are partial
    aggregates, so no key is ever held in one place.
    """
    pos = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_columns())])
    row = F.struct(*[_q(c) for c in changes.columns if c not in keys])
    ends = changes.filter(_q(OP) != BEFORE).groupBy(*keys).agg(
        F.min_by(_q(OP), pos).alias("_first"), F.max_by(row, pos).alias("_last"))
    last = F.col("_last")[OP]
    op = (F.when((F.col("_first") == INSERT) & (last != DELETE), INSERT)
          .when((F.col("_first") == DELETE) & (last != DELETE), AFTER).otherwise(last))
    return ends.filter(~((F.col("_first") == INSERT) & (last == DELETE))).select(
        *[op.cast(changes.schema[OP].dataType).alias(c) if c == OP
          else _q(c) if c in keys else F.col("_last")[c].alias(c) for c in changes.columns])


def apply_deletes(current: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows whose key is not deleted."""
    return current.join(deletes.select(*keys), list(keys), "left_anti")


def apply_updates(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every non-key column takes the value of the update unless that is NULL."""
    rest = [c for c in current.columns if c not in keys]
    new = updates.select(*keys, *[_q(c).alias(f"_new_{c}") for c in rest])
    return current.join(new, list(keys), "left").select(
        *[F.col(c) if c in keys else F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) for c in current.columns])


def unmatched_updates(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates of unknown keys, which become inserts."""
    return updates.join(current.select(*keys), list(keys), "left_anti").select(*current.columns)


def _one_change_per_key(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job when a key occurs twice, as MERGE does for a row matched twice."""
    row = F.struct(*[_q(c) for c in changes.columns if c not in keys])
    grouped = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(row).alias("_row"))
    checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.concat(
        F.lit("more than one change for key "), F.to_json(F.struct(*keys)))).cast(grouped.schema["_row"].dataType))
    return grouped.withColumn("_row", checked).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in changes.columns])


def _fits(df: DataFrame, rows: int, size: int) -> bool:
    """Whether a computed DataFrame stays within a number of rows and of bytes as text."""
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")).first()
    return got["n"] <= rows and (got["size"] or 0) <= size


def merge_cdc(target: DataFrame, changes: DataFrame, keys: Sequence[str], mode: str = "correct",
              null_policy: str = "overwrite", broadcast_rows: int = 0, new_columns: str = "fail") -> DataFrame:
    """New state of ``target``: matched deletes go, matched inserts and updates
    replace the row, the rest is inserted.

    ``mode='correct'`` keeps the last change per key and ignores a delete of an
    unknown key. ``mode='strict'`` is the plain MERGE statement: two changes of a
    key fail the job and an unmatched delete is inserted like any other row.
    ``null_policy='keep'`` leaves a column alone when the update carries NULL. Columns that
    only the changes have fail the merge, or with ``new_columns='add'`` become columns of
    the target, NULL for the rows that no change touches.

    One full outer join, both sides shuffled once on the key. With ``broadcast_rows``
    the reduced change set is computed first; if it stays within that many rows and
    256 MB it is broadcast instead and the target is not shuffled at all.
    """
    keys = _check_keys(keys, target, changes)
    if mode not in ("correct", "strict"):
        raise ValueError(f"unknown mode {mode}")
    extra = [c for c in changes.columns if not c.startswith(META_PREFIX) and c not in target.columns]
    if extra and new_columns != "add":
        raise ValueError(f"columns the target does not have: {extra}")
    target = target.withColumns({c: F.lit(None).cast(changes.schema[c].dataType) for c in extra})
    rows = changes.filter(_q(OP) != BEFORE)
    source = latest_change(rows, keys) if mode == "correct" else _one_change_per_key(rows, keys)
    rest = [c for c in target.columns if c not in keys]
    s = source.select(*keys, _q(OP).alias("_op"), *[F.col(c).alias(f"_s_{c}") for c in rest])
    t = target.select(*target.columns, F.lit(True).alias("_t"))

    small = False
    if broadcast_rows:
        ensure_checkpoint_dir(target.sparkSession)
        s = s.checkpoint()
        small = _fits(s, broadcast_rows, BROADCAST_BYTES)
    if small:
        known = target.select(*keys).join(F.broadcast(s.select(*keys)), keys, "left_semi").checkpoint()
        if not _fits(known, broadcast_rows, BROADCAST_BYTES):  # keys that the target repeats
            known = known.distinct()
        fresh = s.join(F.broadcast(known), keys, "left_anti")
        joined = t.join(F.broadcast(s), keys, "left").unionByName(fresh, allowMissingColumns=True)
    else:
        joined = t.join(s, keys, "full_outer")

    matched, op = F.col("_t").isNotNull(), F.col("_op")
    gone = (op == DELETE) if mode == "correct" else (op == DELETE) & matched

    def value(c: str) -> Column:
        new = F.coalesce(F.col(f"_s_{c}"), F.col(c)) if null_policy == "keep" else F.col(f"_s_{c}")
        return F.when(op.isNull(), F.col(c)).otherwise(new).alias(c)
    return joined.filter(~F.coalesce(gone, F.lit(False))).select(
        *[F.col(c) if c in keys else value(c) for c in target.columns])


def merge_statement(target: str, source: str, keys: Sequence[str], columns: Sequence[str], mode: str = "correct") -> str:
    """MERGE INTO text for a catalog whose tables take row-level changes."""
    guard = f" AND s.`{OP}` <> {DELETE}" if mode == "correct" else ""
    names = ", ".join(f"`{c}`" for c in columns)
    return (f"MERGE INTO {target} AS t USING {source} AS s ON {merge_predicate_text(keys)} "
            f"WHEN MATCHED AND s.`{OP}` = {DELETE} THEN DELETE "
            f"WHEN MATCHED AND s.`{OP}` IN ({INSERT}, {AFTER}) THEN UPDATE SET "
            + ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
            + f" WHEN NOT MATCHED{guard} THEN INSERT ({names}) VALUES ({', '.join(f's.`{c}`' for c in columns)})")


def merge_into(target: str, changes: DataFrame, keys: Sequence[str], mode: str = "correct") -> None:
    """The merge as one statement on a lake table, which rewrites only the files it
    touches. Needs a catalog with row-level changes; a parquet table rejects it and
    takes :func:`merge_cdc` with a full rewrite instead."""
    spark = changes.sparkSession
    rows = changes.filter(_q(OP) != BEFORE)
    source = latest_change(rows, keys) if mode == "correct" else rows
    statement = merge_statement(target, "{source}", keys, spark.table(target).columns, mode)
    spark.sql(statement, source=source)


def apply_cdc(current: DataFrame, changes: DataFrame, keys: Sequence[str], mode: str = "correct") -> DataFrame:
    """The data-frame form of the merge: last change per key, deletes, updates that
    keep a value where they carry NULL, then inserts and unmatched updates.

    The three joins against ``current`` are one full outer join here.
    ``mode='strict'`` appends an insert even when its key exists, so a second run
    doubles it; ``mode='correct'`` takes such an insert as an update.
    """
    keys = _check_keys(keys, current, changes)
    if mode == "correct":
        return merge_cdc(current, changes, keys, "correct", "keep")
    s = latest_change(changes.filter(_q(OP) != BEFORE), keys).select(
        *keys, F.struct(_q(OP).alias("op"), *[F.col(c) for c in current.columns]).alias("_s"))
    t = current.select(*keys, F.struct(*current.columns).alias("_t"))
    op, old, new = F.col("_s.op"), F.col("_t"), F.col("_s")
    kind = current.schema
    patched = F.struct(*[(old[c] if c in keys else F.coalesce(new[c], old[c])).alias(c) for c in current.columns])
    incoming = F.struct(*[new[c].alias(c) for c in current.columns])
    kept = (F.when(old.isNull() | F.coalesce(op == DELETE, F.lit(False)), F.lit(None))
            .when(op == AFTER, patched).otherwise(old))
    added = F.when((op == INSERT) | ((op == AFTER) & old.isNull()), incoming)
    both = F.filter(F.array(kept.cast(kind), added.cast(kind)), lambda r: r.isNotNull())
    return t.join(s, keys, "full_outer").select(F.inline(both))


def replay(current: DataFrame, changes: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Result of applying the changes one after the other.

    A delete removes every copy of its key, an update replaces all of them by one,
    an insert appends a copy without looking. So a key ends with the copies that
    came after its last delete or update, plus its current row when it had neither.
    """
    keys = _check_keys(keys, current, changes)
    rows = changes.filter(_q(OP) != BEFORE).withColumn("_pos", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_columns())]))
    resets = _q(OP).isin(DELETE, AFTER)
    placed = with_group_stats(rows, keys, {"_reset": F.max(F.when(resets, F.col("_pos")))}, hot_rows)
    survivors = placed.filter((_q(OP) != DELETE) & (F.col("_reset").isNull() | (F.col("_pos") >= F.col("_reset"))))
    untouched = current.join(rows.filter(resets).select(*keys).distinct(), keys, "left_anti")
    return untouched.unionByName(survivors.select(*current.columns))


def replace_delete_unmatched(target: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full compare with a snapshot: each row with what happened to it in ``_action``
    (update, insert, delete). The new state is the rows that are not deleted."""
    keys = _check_keys(keys, target, snapshot)
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*target.columns, F.lit(True).alias("_t"))
    s = snapshot.select(*keys, F.lit(True).alias("_s"), *[F.col(c).alias(f"_s_{c}") for c in rest])
    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    action = F.when(in_t & in_s, "update").when(in_s, "insert").otherwise("delete")
    return t.join(s, keys, "full_outer").select(
        *[F.col(c) if c in keys else F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
          for c in target.columns], action.alias("_action"))


def capture_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], lsn: str | Column) -> DataFrame:
    """The change rows between two states of a table: 1, 2, or a pair 3 and 4.

    ``lsn`` marks the commit; within it a key occurs once, so the sequence value is 1.
    """
    keys = _check_keys(keys, before, after)
    columns = before.columns
    mark = F.lit(lsn) if isinstance(lsn, str) else lsn
    kind = before.schema
    b = before.select(*keys, F.struct(*columns).alias("_b"))
    a = after.select(*keys, F.struct(*columns).alias("_a"))
    old, new = F.col("_b"), F.col("_a")
    same = reduce(lambda x, y: x & y, [old[c].eqNullSafe(new[c]) for c in columns if c not in keys], F.lit(True))

    def change(op: int, row: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), row.cast(kind).alias("row"))
    rows = (F.when(new.isNull(), F.array(change(DELETE, old)))
            .when(old.isNull(), F.array(change(INSERT, new)))
            .when(~same, F.array(change(BEFORE, old), change(AFTER, new))))
    return (b.join(a, keys, "full_outer").select(F.explode(rows).alias("c"))
            .select(mark.alias(LSN), F.lit(1).alias(SEQ), F.col("c.op").alias(OP),
                    *[F.col("c.row")[c].alias(c) for c in columns]))


def lsn_bounds(log: DataFrame, instance: str) -> DataFrame:
    """Smallest LSN per capture instance next to the largest of the whole log."""
    per = log.groupBy(instance).agg(F.min(_q(LSN)).alias("min_lsn"), F.max(_q(LSN)).alias("_max"))
    return per.select(instance, "min_lsn", F.max("_max").over(Window.partitionBy(F.lit(0))).alias("max_lsn"))


def envelope_type(row: str) -> str:
    """DDL of the log envelope around a row given as DDL fields."""
    return f"before STRUCT<{row}>, after STRUCT<{row}>, op STRING, source STRUCT<`table`: STRING, ts_ns: BIGINT, db: STRING>"


def flatten_envelope(messages: DataFrame, body: str, row: str) -> DataFrame:
    """Log envelope to a flat row.

    Columns of the row after the change, of the row before it for a delete, which
    stays in the log flagged ``__deleted = 'true'``. A tombstone (NULL body) passes
    as a row of NULLs. Other columns of ``messages`` are kept. ``__error`` says why a
    body gives no row: ``malformed`` (it does not parse or names no operation) or
    ``no row`` (the operation comes without the row it needs); it is NULL otherwise.
    """
    others = [c for c in messages.columns if c != body]
    parsed = messages.withColumn("_e", F.from_json(F.col(body), envelope_type(row)))
    e = F.col("_e")
    names = parsed.select("_e.after.*").columns
    deleted = F.when(e["op"].isNull(), F.lit(None)).when(e["op"] == "d", "true").otherwise("false")
    return parsed.select(
        *others, *[F.when(e["op"] == "d", e["before"][n]).otherwise(e["after"][n]).alias(n) for n in names],
        e["op"].alias("__op"), e["source"]["table"].alias("__table"), e["source"]["ts_ns"].alias("__source_ts_ns"),
        e["source"]["db"].alias("__db"), deleted.alias("__deleted"),
        F.when(F.col(body).isNotNull() & e["op"].isNull(), "malformed")
        .when(F.when(e["op"] == "d", e["before"].isNull()).when(e["op"].isNotNull(), e["after"].isNull()), "no row").alias("__error"))


def soft_delete_view(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("__source_ts_ns",)) -> DataFrame:
    """Current rows of an append-only log that keeps its deletes. Tombstones and rows with
    an ``__error`` name no key and stay in the log only. ``order`` should end in the
    position in the log where times can be equal."""
    w = Window.partitionBy(*keys).orderBy(*[_q(o).desc() for o in order])
    sound = F.col("__op").isNotNull() & (F.col("__error").isNull() if "__error" in log.columns else F.lit(True))
    return (log.filter(sound).drop("__error")
            .withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
            .filter(F.col("__deleted") != "true").drop("__deleted"))


def target_table(db: Column | str, schema: Column | str, table: Column | str, prefix: str = "") -> Column:
    """Name of the table a change goes to, one per source database, schema and table."""
    parts = [F.lit(prefix)] if prefix else []
    return F.concat_ws("_", *parts, db, schema, table)
