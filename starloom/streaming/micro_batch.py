"""Hour folders of fact files as a Structured Streaming query.

Only the arrivals are streamed (paths, not contents).  An hour folder is
loaded as one unit once all its files are there; each trigger reads the files
of all complete folders together, one scan per source.  Two append-only tables
carry the state: the arrived files and the loaded folders.  Both are keyed by
the trigger (stream name, the query id that its checkpoint holds, and epoch),
so a repeated trigger sees the state of before it and replaces its own rows,
while a new checkpoint adds to what earlier ones have loaded.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.build import sources_of
from starloom.plans.runner import RunReport, Warehouse, run_micro_batch
from starloom.sources.files import date_of, hour_of, list_files, logical_file_of, parts_folder
from starloom.sources.tables import BATCH_ID, BatchTable
from starloom.specs import FACT, columns

ARRIVED_SCHEMA = columns("file_date string, file_hour string, file_name string, path string")
LOADED_SCHEMA = columns("file_date string, file_hour string")
DATES_SCHEMA = columns("file_date string, waits boolean")
GROUP = ["file_date", "file_hour"]

# the columns of Spark's binary file source; the content is never selected
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"

# Fixed value: seconds between two triggers.
POLL_SECONDS = 20

# files one trigger takes at most; the rest of a backlog waits for the next one
MAX_FILES = 10_000


def _on(dates: Sequence[str | None]) -> Column:
    """On one of these dates; the other folders are not read."""
    known = F.col("file_date").isin(*[d for d in dates if d is not None])
    return known | F.col("file_date").isNull() if None in dates else known


class Arrivals:
    """Arrived files, loaded folders and late files of one stream.

    The tables lie in date folders, and a ledger says which dates have folders that wait for files: a trigger reads the
    dates of its own files and the open ones, not the history.
    """

    def __init__(self, spark: SparkSession, root: str, required: Sequence[str]):
        self.required = list(required)
        self.files = BatchTable(spark, f"{root}/ArrivedFiles", ARRIVED_SCHEMA, partition_by=("file_date",))
        self.loaded = BatchTable(spark, f"{root}/LoadedFolders", LOADED_SCHEMA, partition_by=("file_date",))
        self.late = BatchTable(spark, f"{root}/LateFiles", ARRIVED_SCHEMA, partition_by=("file_date",))
        # one row a date, the last one counts
        self.dates = BatchTable(spark, f"{root}/OpenDates", DATES_SCHEMA, key="file_date", latest=True)

    def _dates(self, batch_id: str) -> list[str | None]:
        """Dates of the trigger's files, and those that were open before it."""
        # one value a date: bounded by the files per trigger, and by the days with incomplete folders
        own = self.files.read_batches(["file_date"]).filter(F.col(BATCH_ID) == batch_id).select("file_date").distinct()
        waiting = self.dates.read(without=batch_id).filter("waits").select("file_date")
        return [r[0] for r in own.union(waiting).distinct().collect()]

    def note_dates(self, batch_id: str) -> None:
        """Note which of the dates that the trigger has looked at still wait for files."""
        dates = self._dates(batch_id)
        waits = self.pending(dates).select(F.col("file_date").alias("__date")).distinct()
        looked = self.files.read(["file_date"]).filter(_on(dates)).distinct()
        noted = looked.join(waits, F.col("file_date").eqNullSafe(F.col("__date")), "left")
        # paths without a date share one entry, which is never closed
        self.dates.append(noted.select("file_date", (F.col("__date").isNotNull() | F.col("file_date").isNull()).alias("waits")), batch_id)

    def _with_all_parts(self, batch: DataFrame) -> DataFrame:
        """The paths of the trigger; of a file in parts also those that wait for a later trigger, so that it is loaded whole."""
        paths = batch.select("path")
        # directories only, bounded by the files per trigger
        folders = [r[0] for r in paths.select(parts_folder(F.col("path"))).distinct().collect() if r[0] is not None]
        if not folders:
            return paths
        listed = list_files(batch.sparkSession, folders)
        return paths.union(listed.filter(parts_folder(F.col("path")).isNotNull())).distinct()

    def record(self, batch: DataFrame, batch_id: str) -> None:
        path = F.col("path")
        found = self._with_all_parts(batch).select(
            date_of(path).alias("file_date"),
            hour_of(path).alias("file_hour"),
            logical_file_of(path).alias("file_name"),
            "path",
        )
        # a stream with a new checkpoint lists the same files again
        dates = [r[0] for r in found.select("file_date").distinct().collect()]
        seen = self.files.read_batches().filter(_on(dates)).filter(F.col(BATCH_ID) != batch_id)
        seen = seen.select(F.col("file_date").alias("__date"), F.col("path").alias("__path"))
        known = F.col("file_date").eqNullSafe(F.col("__date")) & (F.col("path") == F.col("__path"))
        self.files.append(found.join(seen, known, "left_anti"), batch_id)
        # files of a folder loaded earlier are noted and never deleted; the folder is loaded again
        mine = self.files.read_batches().filter(F.col(BATCH_ID) == batch_id)
        self.late.append(mine.join(self._loaded_before(batch_id, dates), GROUP, "left_semi"), batch_id)

    def _loaded_before(self, batch_id: str, dates: Sequence[str | None]) -> DataFrame:
        return self.loaded.read_batches().filter(_on(dates)).filter(F.col(BATCH_ID) != batch_id).select(*GROUP).distinct()

    def ready(self, batch_id: str) -> DataFrame:
        """Files of the complete folders not loaded before."""
        dates = self._dates(batch_id)
        known = self.files.read().filter(_on(dates)).filter(F.col("file_name").isin(*self.required))
        open_files = known.join(self._loaded_before(batch_id, dates), GROUP, "left_anti")
        counted = open_files.groupBy(*GROUP).agg(F.count_distinct("file_name").alias("n"))
        complete = counted.filter(F.col("n") == len(self.required)).select(*GROUP)
        return open_files.join(complete, GROUP, "left_semi")

    def reopened(self, batch_id: str) -> DataFrame:
        """(batch_id, path): all files of the folders of those triggers to whose folders this one has added files."""
        late = self.late.read_batches().filter(F.col(BATCH_ID) == batch_id).filter(F.col("file_name").isin(*self.required))
        groups = late.select(*GROUP).distinct()
        dates = [r[0] for r in groups.select("file_date").distinct().collect()]  # bounded by the files per trigger
        loaded = self.loaded.read_batches().withColumnRenamed(BATCH_ID, "__trigger")
        triggers = loaded.filter(_on(dates)).join(groups, GROUP, "left_semi").select("__trigger").distinct()
        triggers = [r[0] for r in triggers.collect() if r[0] != batch_id]
        folders = loaded.filter(F.col("__trigger").isin(triggers)).distinct()
        dates = [r[0] for r in folders.select("file_date").distinct().collect()] if triggers else []
        known = self.files.read().filter(_on(dates)).filter(F.col("file_name").isin(*self.required))
        return known.join(folders, GROUP).select(F.col("__trigger").alias(BATCH_ID), "path").distinct()

    def pending(self, dates: Sequence[str | None] | None = None) -> DataFrame:
        """Files waiting for the rest of their folder."""
        files, loaded = self.files.read(), self.loaded.read()
        if dates is not None:
            files, loaded = files.filter(_on(dates)), loaded.filter(_on(dates))
        return files.join(loaded.distinct(), GROUP, "left_anti")


def fact_files(wh: Warehouse) -> list[str]:
    """File names an hour folder must hold before its facts can be built."""
    facts = [t for t in wh.model.tables.values() if t.kind == FACT]
    return sorted(wh.model.sources[s].file for s in sources_of(facts))


def load_arrivals(
    wh: Warehouse, arrivals: Arrivals, batch: DataFrame, batch_id: str, now: Column | None = None
) -> RunReport | None:
    """One trigger: note the arrivals, load every complete folder, note the folders.

    Files that come late for loaded folders load these again, under the name of the trigger that had loaded them: its
    rows are replaced by what a timely load would have given.
    """
    arrivals.record(batch, batch_id)
    _load_late(wh, arrivals, batch_id, now)
    ready = arrivals.ready(batch_id)
    # paths only, bounded by the files per trigger and the open folders
    paths = [r.path for r in ready.select("path").distinct().collect()]
    if not paths:
        arrivals.note_dates(batch_id)
        return None
    report = run_micro_batch(wh, paths, batch_id, now)
    if report.errors:
        # not noted as loaded: the trigger is repeated when the stream is started again
        raise RuntimeError(f"{batch_id} is incomplete: {report.failed}")
    arrivals.loaded.append(ready.select(*GROUP).distinct(), batch_id)
    arrivals.note_dates(batch_id)
    return report


def _load_late(wh: Warehouse, arrivals: Arrivals, batch_id: str, now: Column | None) -> None:
    again: dict[str, list[str]] = {}
    for r in arrivals.reopened(batch_id).collect():  # paths of the folders of the triggers concerned
        again.setdefault(r[0], []).append(r.path)
    for trigger, paths in sorted(again.items()):
        report = run_micro_batch(wh, sorted(paths), trigger, now)
        if report.errors:
            raise RuntimeError(f"late files of {trigger} are incomplete: {report.failed}")


def arrival_stream(
    spark: SparkSession, root: str, max_files: int = MAX_FILES, archive_dir: str | None = None
) -> DataFrame:
    """New files below ``root``.  ``archive_dir`` lets Spark move files it has finished with."""
    reader = spark.readStream.format("binaryFile").schema(FILE_COLUMNS).option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(root).select("path", "modificationTime")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark has given the query of this checkpoint; it stays when the query is started again."""
    line = spark.read.text(f"{checkpoint}/metadata").first()
    return json.loads(line[0])["id"]


def start_stream(
    wh: Warehouse,
    root: str,
    checkpoint: str,
    name: str = "micro_batch",
    available_now: bool = False,
    max_files: int = MAX_FILES,
    archive_dir: str | None = None,
    now: Column | None = None,
    required: Sequence[str] | None = None,
) -> StreamingQuery:
    """Load hour folders as they arrive; ``available_now`` stops after the backlog."""
    arrivals = Arrivals(wh.spark, f"{wh.root}/stream_{name}", required or fact_files(wh))

    def on_trigger(batch: DataFrame, epoch: int) -> None:
        load_arrivals(wh, arrivals, batch, f"{name}-{stream_id(wh.spark, checkpoint)}-{epoch:010d}", now)

    writer = (
        arrival_stream(wh.spark, root, max_files, archive_dir)
        .writeStream.foreachBatch(on_trigger)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{POLL_SECONDS} seconds"}
    return writer.trigger(**trigger).start()
