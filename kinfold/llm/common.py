"""What the operators share: reading tables, walking Arrow batches in bounded portions, folds."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.sources.scratch import scratch_path

#: Texts of this many characters together are worked on at once in a Python worker.
PORTION = 2_000_000


def store(spark: SparkSession, name: str, data: bytes) -> str:
    """Write ``data`` to a new file in the shared folder; its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "files"), name)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    return path.toString()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once for a session, wherever they were started."""
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(f.relative_to(root.parent))), f.read_bytes())
    name = f"{root.name}-{zlib.crc32(packed.getvalue()):08x}.zip"
    if name not in spark.sparkContext._python_includes:
        spark.sparkContext.addPyFile(store(spark, name, packed.getvalue()))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Rows reach the Python workers in smaller batches for as long as this lasts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row, also inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def fold(column: str, n: int) -> Column:
    """``crc32(column as text) mod n``; a NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def portions(column: pa.Array, size: int = PORTION) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a batch, about ``size`` characters at a time, with the row of the first of them.
    Only these become Python strings at once."""
    lengths = pc.utf8_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(lengths.tolist()):
        total += n
        if total >= size or i == len(lengths) - 1:
            yield start, column.slice(start, i + 1 - start).to_pylist()
            start, total = i + 1, 0


def map_texts(
    docs: DataFrame,
    keep: Sequence[str | Column],
    schema: Sequence[str],
    make: Callable[[], Callable[[list[str]], Sequence[Sequence]]],
) -> DataFrame:
    """Add columns computed from ``text`` alone, portion by portion.

    ``make`` is called once for each task and returns a function from a list of texts (NULL given
    as the empty text) to the new columns. ``keep`` are the columns to return before them,
    ``schema`` declares each new one. Every row is computed from that row only, so a lost task is
    simply run again.
    """
    narrow = docs.select(*keep, F.col("text").alias("_text"))
    kept = narrow.drop("_text")
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for a, texts in portions(batch.column(batch.num_columns - 1)):
                new = apply([t or "" for t in texts])
                old = [batch.column(k).slice(a, len(texts)) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*old, *(c if isinstance(c, pa.Array) else pa.array(c) for c in new)],
                    names=[*batch.schema.names[:-1], *names],
                )

    names = [c.split()[0] for c in schema]
    return narrow.mapInArrow(run, ", ".join([*([declared] if declared else []), *schema]))


def filter_texts(
    docs: DataFrame, make: Callable[[], Callable[[list[str]], Sequence[bool]]]
) -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for a, texts in portions(batch.column(at)):
                stay = pa.array(apply([t or "" for t in texts]), pa.bool_())
                yield batch.slice(a, len(texts)).filter(stay)

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)
