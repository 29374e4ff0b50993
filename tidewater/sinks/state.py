"""Keyed position state (W-07): ``mmsi:<MMSI> -> {latitude, longitude}``.

The state is a table bucketed and sorted by ``key``, so an upsert shuffles
the batch's few positions to the buckets and never the state, and a lookup
reads one bucket. The newer arrival wins, so merging a batch again changes
nothing: a retried micro-batch is safe. The merged table is written beside
the current one and takes its name when it is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stateful import REPORT_ORDER, current_positions
from ..session import scratch_path

STATE_COLUMNS = ["key", "latitude", "longitude", "arrival_ts"]


def state_key(mmsi) -> F.Column:
    return F.concat(F.lit("mmsi:"), mmsi.cast("string"))


def batch_positions(reports: DataFrame, key: str = "MMSI", lat: str = "Lat",
                    lng: str = "Lng") -> DataFrame:
    """Reduce a batch to its last valid position per vessel (partial agg)."""
    last = current_positions(reports.where(F.col(key).isNotNull()), key, lat, lng,
                             order=REPORT_ORDER)
    return last.select(state_key(F.col(key)).alias("key"), F.col(lat).alias("latitude"),
                       F.col(lng).alias("longitude"), "arrival_ts")


def upsert_positions(state: DataFrame | None, reports: DataFrame) -> DataFrame:
    """W-07 merge: full outer join of the state with the batch's last
    positions on ``key``; the newer arrival wins. Both sides have one row per
    key, so the join is 1:1."""
    new = batch_positions(reports)
    if state is None:
        return new
    s, n = state.alias("s"), new.alias("n")
    newer = F.col("n.key").isNotNull() & (
        F.col("s.key").isNull() | (F.col("n.arrival_ts") >= F.col("s.arrival_ts")))
    return s.join(n, F.col("s.key") == F.col("n.key"), "full_outer").select(
        *[F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
          for c in STATE_COLUMNS])


def _following(table: str) -> str:
    return f"{table}__next"


def read_state(spark: SparkSession, table: str) -> DataFrame | None:
    """The state of that name, None if there is none. A merged table that
    lost its writer before it took the name takes it now: it is only there
    once it is whole."""
    if not spark.catalog.tableExists(table):
        if not spark.catalog.tableExists(_following(table)):
            return None
        spark.sql(f"ALTER TABLE {_following(table)} RENAME TO {table}")
    return spark.table(table)


def write_upsert(spark: SparkSession, table: str, reports: DataFrame, buckets: int | None = None) -> None:
    """Merge a batch into the state table of that name. A new table takes
    ``buckets`` (the session's shuffle partitions), a known one keeps its own.
    Files lie under the shared folder; those of the merged state are new, and
    those of the former stay for its readers."""
    known = read_state(spark, table)
    if known is not None:
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        buckets = int(described["Num Buckets"])
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged, following = upsert_positions(known, reports), _following(table)
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    merged.repartition(buckets, "key").write.bucketBy(buckets, "key").sortBy("key") \
        .option("path", scratch_path(spark, table)).saveAsTable(following)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")


def lookup(state: DataFrame, mmsi: str) -> DataFrame:
    """Point lookup by vessel: one bucket of a bucketed state is read."""
    return state.where(F.col("key") == F.lit(f"mmsi:{mmsi}"))
