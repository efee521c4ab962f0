"""Keeping lake tables in step with their source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lsn import LSN_DEFAULT
from tidemark.operators import cdc
from tidemark.operators.tables import VersionedTable

SMALL_CHANGE_SET = 200_000


@dataclass(frozen=True)
class Source:
    """A source table: its current rows, its change log (None when capture is off), its
    key, and the LSN from which the log is complete if old changes are removed."""

    snapshot: Callable[[], DataFrame]
    changes: Callable[[], DataFrame] | None
    keys: Sequence[str]
    min_lsn: str | None = None


@dataclass(frozen=True)
class SyncResult:
    action: str  # full, merged or unchanged
    version: int
    last_lsn: str
    rows: int


def _max_lsn(log: DataFrame) -> str | None:
    return log.agg(F.max(f"`{cdc.LSN}`").alias("high")).first()["high"]


def sync(table: VersionedTable, source: Source, broadcast_rows: int = SMALL_CHANGE_SET) -> SyncResult:
    """Full load without state or data, otherwise merge the changes after the last LSN.

    The LSN of a full load is read before the rows, so a change that arrives in
    between is applied again by the next run instead of lost. A ``HashedTable`` rewrites only the
    parts that the changes touch. Only the last LSN and the control row come to the driver.
    """
    if source.changes is None:
        raise ValueError(f"change capture is not enabled for {table.name}")
    log = source.changes()
    high = _max_lsn(log)
    state = table.state()
    if state is None or state["last_lsn"] == LSN_DEFAULT:
        row = table.write(source.snapshot(), last_lsn=high or LSN_DEFAULT)
        return SyncResult("full", row["version"], row["last_lsn"], row["row_count"])
    last = state["last_lsn"]
    if high is None or high <= last:
        return SyncResult("unchanged", state["version"], last, state["row_count"])
    changes = cdc.read_changes(log, last, high, after=True, min_lsn=source.min_lsn)
    row = table.rewrite(changes.select(*source.keys),
                        lambda current: cdc.merge_cdc(current, changes, source.keys, broadcast_rows=broadcast_rows), high)
    return SyncResult("merged", row["version"], row["last_lsn"], row["row_count"])


def sync_all(tables: Mapping[str, tuple[VersionedTable, Source]]) -> dict[str, SyncResult]:
    """The same for a list of tables; each is its own set of Spark jobs."""
    return {name: sync(table, source) for name, (table, source) in tables.items()}
