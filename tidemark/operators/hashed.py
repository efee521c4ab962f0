"""A stored table in parts by the hash of its key, of which a change rewrites those it touches.

The parts are partition folders that Spark overwrites one by one (dynamic partition overwrite) and prunes when
it reads; a part without rows keeps a marker row, so that it can be overwritten by nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.tables import VersionedTable

PART, MARKER = "__part", "__marker"


class HashedTable(VersionedTable):
    """``<root>/<name>/v=<n>-<attempt>/__part=<hash of the key>/`` parquet plus control rows.

    ``rewrite`` first writes the new rows of the touched parts to a folder of their own, names that folder, exchanges
    the parts and then commits the LSN and the batch id. If the driver dies on the way, the next
    call exchanges the parts again from that folder, so nothing is lost or applied in halves. Other than
    a :class:`VersionedTable`, a reader that runs during the exchange may see old and new parts together,
    and earlier versions are gone. Columns that come later are NULL in the parts written before.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, keys: Sequence[str], parts: int = 64):
        if not keys:
            raise ValueError("a hashed table needs its keys")
        super().__init__(spark, root, name)
        self.keys, self.parts = list(keys), parts

    def _stored(self, folder: str, schema: str) -> DataFrame:
        """Small bookkeeping rows, none before the first."""
        path = f"{self.root}/{self.name}/{folder}"
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _note(self, folder: str, version: int, text: str) -> None:
        row = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(text).alias("text"))
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/{self.name}/{folder}")

    def _noted(self, folder: str) -> Row | None:
        return self._stored(folder, "version BIGINT, text STRING").orderBy(F.desc("version")).first()

    def stored_schema(self) -> T.StructType:
        """The columns of the table, those added by changes included."""
        return T.StructType.fromJson(json.loads(self._noted("schema")["text"]))

    def part_of(self, schema: T.StructType) -> Column:
        """The part of a row, whatever integer or text type its keys come in."""
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast(schema[k].dataType) for k in self.keys]), F.lit(self.parts)).cast("int")

    def _rows(self, path: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(MARKER, T.BooleanType()), T.StructField(PART, T.IntegerType())])
        return self.spark.read.schema(whole).parquet(path)

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows of the table, or of some parts of it."""
        state = self.state()
        if state is None:
            raise ValueError(f"table {self.name} has no data")
        rows = self._rows(state["path"], self.stored_schema())
        if parts is not None:
            rows = rows.filter(F.col(PART).isin([int(p) for p in parts]))
        return rows.filter(f"NOT {MARKER}").drop(MARKER, PART)

    def write(self, df: DataFrame, last_lsn: str | None = None, batch_id: int | None = None, partition_by: Sequence[str] = ()) -> Row:
        """A full load: all parts of a new folder."""
        if partition_by:
            raise ValueError("a hashed table is partitioned by its key")
        old = self.state()
        version = (old["version"] if old else 0) + 1
        path = f"{self.root}/{self.name}/v={version}-{uuid.uuid4().hex}"
        self._marked(df, range(self.parts), df.schema).write.partitionBy(PART).parquet(path)
        self._note("schema", version, df.schema.json())
        return self._commit(version, path, last_lsn, batch_id, old, df.sparkSession.read.parquet(path).count() - self.parts)

    def _marked(self, rows: DataFrame, parts: Sequence[int], schema: T.StructType) -> DataFrame:
        """Rows with their part, together, and a marker for each part."""
        listed = self.spark.createDataFrame([(int(p),) for p in parts], f"{PART} INT")
        markers = listed.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.lit(True).alias(MARKER), PART)
        return rows.withColumns({MARKER: F.lit(False), PART: self.part_of(schema)}).unionByName(markers).hint("rebalance", PART)

    def state(self) -> Row | None:
        """The state, after an exchange that was named but not committed has been done again."""
        state, pending = super().state(), self._noted("pending")
        if state is None or pending is None or pending["version"] <= state["version"]:
            return state
        note = json.loads(pending["text"])
        if note["path"] != state["path"]:
            return state
        return self._exchange(state, pending["version"], note)

    def _exchange(self, state: Row, version: int, note: dict) -> Row:
        """Overwrite the staged parts, then commit."""
        schema = T.StructType.fromJson(note["schema"])
        staged = self._rows(note["staged"], schema)
        (staged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PART).parquet(note["path"]))
        return self._commit(version, note["path"], note["last_lsn"], note["batch_id"], state, note["rows"])

    def rewrite(self, touching: DataFrame, apply: Callable[[DataFrame], DataFrame], last_lsn: str | None = None,
                batch_id: int | None = None) -> Row:
        """New rows for the parts in which the keys of ``touching`` lie: ``apply`` gets their current rows.

        ``apply`` may change, add and remove rows with these keys and leaves the others. Only the numbers of the touched parts come to
        the driver. The other parts are neither read nor written.
        """
        state = self.state()
        if state is None:
            raise ValueError(f"table {self.name} needs a full load first")
        schema = self.stored_schema()
        touched = sorted(r[0] for r in touching.select(self.part_of(schema).alias("p")).distinct().collect())  # at most ``parts``
        if not touched:
            return self._commit(state["version"] + 1, state["path"], last_lsn, batch_id, state, state["row_count"])
        current = self.read(touched)
        new = apply(current)
        wider = T.StructType([*schema.fields, *[f for f in new.schema.fields if f.name not in schema.names]])
        outside = F.raise_error(F.lit(f"a row of table {self.name} left the parts that the change touches"))
        part = self.part_of(wider)
        new = new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wider.fields])
        marked = self._marked(new, touched, wider).withColumn(
            PART, F.when(F.col(MARKER) | part.isin(touched), F.col(PART)).otherwise(outside.cast("int")))
        version = state["version"] + 1
        staged = f"{self.root}/{self.name}/staged-{version}-{uuid.uuid4().hex}"
        marked.write.partitionBy(PART).parquet(staged)
        rows = state["row_count"] - current.count() + self.spark.read.parquet(staged).count() - len(touched)
        note = {"path": state["path"], "staged": staged, "schema": wider.jsonValue(), "last_lsn": last_lsn, "batch_id": batch_id, "rows": rows}
        if wider != schema:
            self._note("schema", version, wider.json())  # NULL until the parts are exchanged
        self._note("pending", version, json.dumps(note))
        return self._exchange(state, version, note)
