"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airmesh.session import materialize

#: Words as the operators' contracts take them: runs of anything but blank and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that go to Python and back at a time.
FLUSH_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MADE: ContextVar[list[DataFrame] | None] = ContextVar("tables made", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is a file scan."""
    out = materialize(df, f"llm-{name}")
    if (made := _MADE.get()) is not None:
        made.append(out)
    return out


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Within it, ``stored`` lists the tables it makes; those still listed at its end belong to a scratch around it."""
    made: list[DataFrame] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if (outer := _MADE.get()) is not None:
            outer.extend(made)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored``; nothing may read it afterwards."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/airmesh-tables/llm-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


#: Rows of whole texts that Spark hands to Python at a time; its default of 10,000 is meant for narrow rows.
BATCH_ROWS = 1000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, as ``--py-files`` would, once per application.

    Where the session leaves Arrow batches at Spark's default, they are made smaller.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_KEY) == "10000":
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="airmesh-py-"), "airmesh.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(Path(root.name) / file.relative_to(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def map_rows(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` whose function may use this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def id_fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 4; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4).cast("int")


def n_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def heaviest(df: DataFrame, weight: str, most: int) -> int:
    """The least power of two w such that at most ``most`` rows have ``weight`` >= w.

    One aggregation to at most 64 rows; no sort.  Rows from w up are what may
    be broadcast: ``most`` bounds them at any size of the input.
    """
    classes = (df.groupBy(F.floor(F.log2(F.greatest(F.col(weight), F.lit(1)))).alias("c"))
               .count().collect())
    total, floor = 0, 62
    for row in sorted(classes, key=lambda r: -r["c"]):
        total += row["count"]
        if total > most:
            break
        floor = row["c"]
    return 2 ** floor


class RowBuffer:
    """Collects rows column by column and cuts them into Arrow batches."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)

    def __len__(self) -> int:
        return len(self.columns[0])

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)],
            schema=self.schema)
        self.columns = [[] for _ in self.schema]
        return out

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self) >= FLUSH_ROWS:
            yield self.batch()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if len(self):
            yield self.batch()


def texts_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of ``columns`` as Python values, a slice of a batch at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)
