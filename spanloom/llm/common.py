"""What the text operators share: tables on the way, sorted runs of Arrow rows, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from spanloom import session

#: Rows handed to Python at once; texts may be long, so a batch is kept small.
BATCH_ROWS = 1000

Batches = Iterator[pa.RecordBatch]


def prepare(spark: SparkSession) -> SparkSession:
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = session.new_run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, function: Callable[[Batches], Iterable], schema: str) -> DataFrame:
    """``mapInArrow`` over record batches; the function yields dictionaries of columns or batches."""
    arrow = df.sparkSession.createDataFrame([], schema)
    kind = _arrow_schema(arrow)

    def run(batches: Batches) -> Batches:
        for out in function(batches):
            if isinstance(out, dict):
                arrays = [
                    v if isinstance(v, pa.Array) else pa.array(v, kind.field(k).type)
                    for k, v in ((f.name, out[f.name]) for f in kind)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=kind)
            else:
                yield out

    return df.mapInArrow(run, schema)


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def strings(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null reads as empty."""
    return [x or "" for x in column.to_pylist()]


def sorted_runs(batches: Batches, keys: list[str]) -> Iterator[pa.Table]:
    """Tables in which every key is complete, from rows sorted by the keys.

    Rows of the last key of a batch wait for the next batch, so memory is one batch plus one key.
    """
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        end = tuple(c[batch.num_rows - 1].as_py() for c in columns)
        begin = tuple(c[0].as_py() for c in columns)
        if waiting and begin != last:
            yield pa.Table.from_batches(waiting)
            waiting = []
        if begin != end:
            # first row of the last key
            same = np.ones(batch.num_rows, bool)
            for c, v in zip(columns, end, strict=True):
                same &= (
                    np.asarray(c.is_null()) if v is None
                    else np.asarray(pc.fill_null(pc.equal(c, v), False))
                )
            cut = batch.num_rows - int(np.argmin(same[::-1]))
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = []
            batch = batch.slice(cut)
        waiting.append(batch)
        last = end
    if waiting:
        yield pa.Table.from_batches(waiting)


def run_bounds(table: pa.Table, keys: list[str]):
    """Start offsets of the runs of equal keys, and the number of rows at the end."""
    n = table.num_rows
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        codes = np.asarray(table.column(k).combine_chunks().dictionary_encode("encode").indices)
        change[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(change), n)
