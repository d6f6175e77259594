"""What the operators share on Spark's side: shipping the package, reading tables, staging, text-sized batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import apply_runtime_conf, scratch_path

#: Bytes of text that a task looks at in one go; longer texts come alone.
CHUNK_BYTES = 1 << 20

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings, and the package sent to the executors' Python workers (once for each application)."""
    apply_runtime_conf(spark)
    # few rows at a time: texts are long, and a worker holds one batch of them
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="starloom-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent).as_posix())
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.format(fmt).options(**({"compression": "zstd"} | options)).save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` bytes of ``column``, one row at least."""
    from starloom.llm.kernels import text_bytes

    _, offsets = text_bytes(batch.column(column))
    n, i = batch.num_rows, 0
    while i < n:
        j = max(i + 1, int(offsets.searchsorted(offsets[i] + limit, "right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = j


def map_texts(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], object]], schema: str, text: str = "text") -> DataFrame:
    """``make()`` once in each task gives a function of small batches; it returns a dict of columns, or None."""
    names = [f.name for f in _fields(schema)]

    def run(batches):
        f = make()
        for batch in batches:
            for part in chunks(batch, text):
                if (out := f(part)) is not None:
                    yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _array(values: object) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def _fields(schema: str) -> list:
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema).fields


def crc_mod(column: str, mod: int) -> F.Column:
    """crc32 of the value's text, modulo ``mod``: the fold that a row belongs to (null: no fold)."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(mod))


def runs(batches, keys: tuple[str, ...]):
    """(key, table) for each run of rows with equal keys in a stream that is sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = columns[0][1:] != columns[0][:-1]
        for c in columns[1:]:
            new = new | (c[1:] != c[:-1])
        bounds = [0, *(new.nonzero()[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield last, pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held).combine_chunks()


def map_runs(df: DataFrame, keys: tuple[str, ...], f: Callable, schema: str) -> DataFrame:
    """``f(key, table)`` of all rows with equal keys; it returns a dict of columns, or None."""
    names = [x.name for x in _fields(schema)]

    def run(batches):
        for key, rows in runs(batches, keys):
            if (out := f(key, rows)) is not None:
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def scratch_partitions(spark: SparkSession) -> int:
    """Tasks that a shuffle of this session has at least."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bits of the filter of ``maybe_among``: 8 MB, whatever the number of keys.
FILTER_BITS = 1 << 26


def maybe_among(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``: false only where the value of ``key`` is surely not among ``keys`` (one column).

    A bitmap of fixed size is sent to all tasks, so that rows that a join would drop, or keep as they are, need not be
    shuffled.  With more keys than bits it says maybe everywhere, and the join after it has all rows again.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    own = keys.select(bit(F.col(keys.columns[0])).alias("_bit"))
    maps = own.groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))
    place = F.bitmap_bit_position(bit(F.col(key)))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    marked = df.join(F.broadcast(maps), F.bitmap_bucket_number(bit(F.col(key))) == F.col("_bucket"), "left")
    return marked.select(*df.columns, F.coalesce(hit, F.lit(False)).alias("_maybe"))
