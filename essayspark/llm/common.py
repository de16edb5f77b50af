"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from essayspark.session import ensure_checkpoint_dir, ship_package

__all__ = ["free_names", "map_batches", "remainder", "written", "table", "ensure_checkpoint_dir", "ship_package"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the input folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % mod


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores added as it takes not to clash with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: later reads, also after an executor is lost, start from these files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list] | None]],
                schema: str, rows: int = 512) -> DataFrame:
    """Apply ``make()`` (called once in every task) to slices of at most
    ``rows`` rows.  It gets and returns columns as a dict of lists; it may
    have a ``rest()`` attribute that yields what is left at the task's end."""
    ship_package(df.sparkSession)
    fields = df.sparkSession.createDataFrame([], schema).schema
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        step = make()

        def pack(cols):
            return pa.RecordBatch.from_arrays([pa.array(cols[n], type=out.field(n).type) for n in names], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                cols = step({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)})
                if cols is not None and len(cols[names[0]]):
                    yield pack(cols)
        for cols in getattr(step, "rest", lambda: ())():
            yield pack(cols)

    return df.mapInArrow(run, fields)
