"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidewater.session import checkpoint_root

#: Rows turned into Python objects at a time inside an Arrow batch, so that
#: long texts are not all copied at once.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast: ``pick(df, doc_id="long")``. Extra
    columns, whatever their names, go no further; a missing one is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(kind).alias(c)
                       for c, kind in columns.items()])


def cut(df: DataFrame) -> DataFrame:
    """Materialise and cut the lineage with a reliable checkpoint in the
    shared folder; it survives the loss of any executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and reread."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame, *keys: str, rows_per_task: int | None = None) -> DataFrame:
    """Deal rows by key into the session's shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
          "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
          "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}


def arrow_schema(ddl: str) -> pa.Schema:
    fields = _parse_datatype_string(ddl)
    assert isinstance(fields, StructType)
    return pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in fields])


def map_lists(df: DataFrame, make: Callable[[], Callable[..., list]], ddl: str) -> DataFrame:
    """Apply a function of column lists to each slice of rows, in Arrow
    batches. ``make()`` runs once per task and returns the function; it takes
    one Python list per input column and returns one list per output column."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                out = apply(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return df.mapInArrow(run, ddl)


class Kept(dict):
    """Results of a function by argument, within a task. At most about
    ``most`` are kept: when half as many are young, they become the old ones,
    and the former old ones, unless asked for meanwhile, go."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if 2 * len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
