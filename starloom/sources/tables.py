"""Warehouse tables as folders of batches, resolved when they are read.

A batch is a folder of parquet files that its writer alone touches; the same batch again replaces its own rows.  What is
stored is never rewritten by a change: an upsert appends the changed rows, a removal appends keys.

* A table without key holds all rows of all batches.
* A table with a key holds them but for the removed keys.
* A table with ``latest`` holds of each key the row that was written last, found by one aggregate that reduces on the map
  side (merge on read).  Of two writers of one key the later one counts, for every reader.

``compact`` puts the batches of a ``latest`` table together, ``expire`` deletes the folders whose rows are all outdated.
Both leave what other writers append meanwhile.  ``partition_by`` columns, and with ``day_of`` the day of a timestamp,
become folders too, so that filters on them skip the other folders, and old days can be dropped as a whole.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from starloom.session import delete_folder

BATCH_ID = "batch_id"
_WRITTEN = "__written"
_DAY = "__day"
_REMOVED = "__removed_key"


class BatchTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        partition_by: Sequence[str] = (),
        key: str | None = None,
        latest: bool = False,
        day_of: str | None = None,
    ):
        if day_of is not None and partition_by:
            raise ValueError(f"{path}: folders by day and by {list(partition_by)}")
        if latest and key is None:
            raise ValueError(f"{path}: the latest rows of which key?")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = list(partition_by)
        self.key = key
        self.latest = latest
        self.day_of = day_of
        self._last = 0

    def _moment(self) -> int:
        """Microseconds, later than the last ones of this object."""
        self._last = max(self._last + 1, time.time_ns() // 1000)
        return self._last

    def _stored(self, folder: str, schema: StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _batches(self) -> DataFrame | None:
        extra = [StructField(BATCH_ID, StringType())]
        if self.key is not None:
            extra.append(StructField(_WRITTEN, LongType()))
        if self.day_of is not None:
            extra.append(StructField(_DAY, DateType()))
        fields = [*self.schema.fields, *extra]
        rows = self._stored("batches", StructType(fields))
        return None if rows is None else rows.select(*[f.name for f in fields])

    def _removals(self) -> DataFrame | None:
        if self.key is None:
            return None
        fields = [StructField(_REMOVED, self.schema[self.key].dataType), StructField(_WRITTEN, LongType()), StructField(BATCH_ID, StringType())]
        return self._stored("removed", StructType(fields))

    def _resolved(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``columns`` of the rows that count, ``rows`` being stored ones."""
        gone = self._removals()
        if self.latest:
            body = [c for c in rows.columns if c in columns or c in (_WRITTEN, self.key)]
            # the struct begins with the time, so the largest one is the last one
            entry = F.struct(F.col(_WRITTEN), F.lit(0).alias("gone"), *[F.col(c) for c in body if c not in (_WRITTEN, self.key)])
            entries = rows.select(F.col(self.key).alias("__key"), entry.alias("__row"))
            if gone is not None:
                blank = F.struct(F.col(_WRITTEN), F.lit(1).alias("gone"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in body if c not in (_WRITTEN, self.key)])
                entries = entries.union(gone.select(F.col(_REMOVED), blank))
            order = F.struct("__row.__written", "__row.gone")
            last = entries.groupBy("__key").agg(F.max_by("__row", order).alias("__row")).filter("__row.gone = 0")
            return last.select(*[F.col("__key").alias(c) if c == self.key else F.col(f"__row.{c}").alias(c) for c in columns])
        if gone is not None:
            earlier = (F.col(self.key) == gone[_REMOVED]) & (rows[_WRITTEN] < gone[_WRITTEN])
            rows = rows.join(gone.drop(BATCH_ID), earlier, "left_anti")
        return rows.select(*columns)

    def read_batches(self, columns: Sequence[str] | None = None, without: str | None = None) -> DataFrame:
        """The rows that count with the batch that wrote them; ``without`` leaves a batch out, as if it had not been."""
        columns = [*(columns or self.schema.fieldNames()), BATCH_ID]
        rows = self._batches()
        if rows is None:
            types = StructType([*self.schema.fields, StructField(BATCH_ID, StringType())])
            # the planner sees that this is empty, and drops the joins with it
            return self.spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(types[c].dataType).alias(c) for c in columns])
        if without is not None:
            rows = rows.filter(F.col(BATCH_ID) != without)
        return self._resolved(rows, columns)

    def read(self, columns: Sequence[str] | None = None, without: str | None = None) -> DataFrame:
        return self.read_batches(columns, without).drop(BATCH_ID)

    def append(self, df: DataFrame, batch_id: str) -> None:
        """Add the rows of one batch; running the batch again replaces them.  With ``latest`` they stand for their keys from now on."""
        self._write(df.withColumn(_WRITTEN, F.lit(self._moment())), batch_id)

    def _write(self, df: DataFrame, batch_id: str) -> None:
        out = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        if self.key is not None:
            out.append(F.col(_WRITTEN))
        folders = self.partition_by
        if self.day_of is not None:
            out.append(F.to_date(self.day_of).alias(_DAY))
            folders = [*folders, _DAY]
        df = df.select(*out)
        if folders:
            # few files per folder; a folder that is too large for one is split
            df = df.hint("rebalance", *folders)
        df.write.mode("overwrite").partitionBy(*folders).parquet(f"{self.path}/batches/{BATCH_ID}={batch_id}")

    def remove(self, keys: DataFrame, batch_id: str) -> None:
        """Leave out the rows with these keys (one column) that have been written by now."""
        if self.key is None:
            raise ValueError(f"{self.path} has no key to remove rows by")
        named = keys.select(F.col(keys.columns[0]).cast(self.schema[self.key].dataType).alias(_REMOVED)).distinct()
        named.withColumn(_WRITTEN, F.lit(self._moment())).write.mode("overwrite").parquet(f"{self.path}/removed/{BATCH_ID}={batch_id}")

    def compact(self) -> list[str]:
        """Put the batches of a ``latest`` table together; returns the batches that went.

        The rows keep the time at which they were written, so readers find the same before, between and after the steps,
        and a compaction that stops halfway does no harm.  Batches that are appended meanwhile are left alone.
        """
        if not self.latest:
            raise ValueError(f"{self.path}: only the latest rows of keys can be put together")
        stored, gone = self._batches(), self._removals()
        if stored is None:
            return []
        batches = [r[0] for r in stored.select(BATCH_ID).distinct().collect()]  # one value a batch
        removals = [] if gone is None else [r[0] for r in gone.select(BATCH_ID).distinct().collect()]
        seen = stored.filter(F.col(BATCH_ID).isin(batches))
        self._write(self._resolved(seen, [*self.schema.fieldNames(), _WRITTEN]), f"compacted-{uuid.uuid4().hex}")
        for b in batches:
            delete_folder(self.spark, f"{self.path}/batches/{BATCH_ID}={b}")
        for b in removals:
            delete_folder(self.spark, f"{self.path}/removed/{BATCH_ID}={b}")
        return batches

    def expire(self, old: Column, batch_id: str) -> list[str]:
        """Drop the rows for which ``old`` holds; returns the folders that were deleted.

        A folder of a batch and day goes as a whole once no row in it counts any more.  Of the others, the outdated rows
        are removed by key, which concerns the days at the border alone.  Removed keys that no stored row has are dropped.
        """
        if self.day_of is None or self.latest:
            raise ValueError(f"{self.path} is not stored by day")
        stored = self._batches()
        if stored is None:
            return []
        columns = [*self.schema.fieldNames(), BATCH_ID, _DAY, _WRITTEN]
        counting = self._resolved(stored, columns).filter(~F.coalesce(old, F.lit(False)))
        folders = stored.select(BATCH_ID, _DAY).distinct().withColumnsRenamed({BATCH_ID: "__b", _DAY: "__d"})
        left = counting.select(BATCH_ID, _DAY).distinct()
        empty = folders.join(left, (F.col("__b") == F.col(BATCH_ID)) & F.col("__d").eqNullSafe(F.col(_DAY)), "left_anti")
        names = [(r[0], r[1]) for r in empty.collect()]  # one row a batch and day that goes
        border = self._resolved(stored, columns).filter(F.coalesce(old, F.lit(False)))
        kept = border.join(empty, (F.col("__b") == F.col(BATCH_ID)) & F.col("__d").eqNullSafe(F.col(_DAY)), "left_anti")
        if not kept.isEmpty():
            self.remove(kept.select(self.key), batch_id)
        paths = [f"{self.path}/batches/{BATCH_ID}={b}/{_DAY}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for b, d in names]
        for p in paths:
            delete_folder(self.spark, p)
        self._drop_idle_removals()
        return paths

    def _drop_idle_removals(self) -> None:
        stored, gone = self._batches(), self._removals()
        if stored is None or gone is None:
            return
        used = gone.join(stored.select(self.key), F.col(_REMOVED) == F.col(self.key), "left_semi").select(BATCH_ID).distinct()
        idle = gone.select(BATCH_ID).distinct().join(used, BATCH_ID, "left_anti")
        for r in idle.collect():  # one row a removal
            delete_folder(self.spark, f"{self.path}/removed/{BATCH_ID}={r[0]}")
