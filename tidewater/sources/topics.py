"""Report sources: topic streams and replays, files, bounded and offset-range
reads, topic catalogue and subscription filters (area, vessel, type).

A topic row has the Kafka shape ``key, value, topic, partition, offset,
timestamp``. With the Kafka connector on the classpath the stream readers use
``format("kafka")``; otherwise (tests, offline) they read Kafka-shaped
parquet rows from a folder with the file source.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ordering
from ..operators.decode import parsed
from ..schemas import REPORT, TOPIC_ROW
from . import json_arrays

#: Levels of the cells that cover boxes: level L halves the globe L times in
#: either direction. A box is covered at the finest level at which it is at most
#: CELLS_ACROSS cells wide and high, or at the coarsest.
COVER_LEVELS = (6, 10, 14, 18)
CELLS_ACROSS = 16

# The collector's configured area of interest (whole world)
# and the producer's two boxes, corners as [lat, lng] in either order.
WORLD_BOXES = [[[-90.0, -180.0], [90.0, 180.0]]]
PRODUCER_BOXES = [
    [[25.835302, -80.207729], [25.602700, -79.879297]],
    [[33.772292, -118.356139], [33.673490, -118.095731]],
]


def _kafka_frame(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def read_reports(spark: SparkSession, topics: str | Sequence[str], *, start: str = "latest",
                 max_per_trigger: int | None = None, bootstrap: str | None = None,
                 path: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """S-01 (``start='latest'``) / S-02 (``start='earliest'``): a streaming
    frame of topic rows. Lost offsets stop the query unless ``options`` say
    otherwise. ``bootstrap`` selects Kafka; ``path`` the offline
    file source of Kafka-shaped parquet rows (always from the beginning)."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if bootstrap:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", ",".join(names))
                  .option("startingOffsets", start))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return _kafka_frame(reader.load())
    if path is None:
        raise ValueError("give bootstrap servers (Kafka) or a path (file source)")
    reader = spark.readStream.schema(TOPIC_ROW)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.parquet(path).where(F.col("topic").isin(names))


def read_topic_batch(spark: SparkSession, topics: str | Sequence[str], *,
                     bootstrap: str | None = None, path: str | None = None,
                     starting: str = "earliest", ending: str = "latest") -> DataFrame:
    """Batch read of topic rows (Kafka ``startingOffsets``/``endingOffsets``
    JSON or keywords; or Kafka-shaped parquet)."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if bootstrap:
        return _kafka_frame(spark.read.format("kafka")
                            .option("kafka.bootstrap.servers", bootstrap)
                            .option("subscribe", ",".join(names))
                            .option("startingOffsets", starting)
                            .option("endingOffsets", ending).load())
    return spark.read.schema(TOPIC_ROW).parquet(path).where(F.col("topic").isin(names))


def read_json_array_file(spark: SparkSession, path: str) -> DataFrame:
    """S-03: a file holding one JSON array of reports, one row per report.
    ``multiLine`` reads each file whole, so it suits files of bounded size;
    ``read_json_array_split`` reads large ones by many tasks."""
    return spark.read.option("multiLine", True).schema(REPORT).json(path)


def _carried(splits: DataFrame, value: Column, out: str) -> DataFrame:
    """Splits with ``out``, the sum of ``value`` over those before in the file."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn(out, F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def read_json_array_split(spark: SparkSession, path: str) -> DataFrame:
    """S-03 for files of any size: the reports of JSON arrays of objects, each
    file read by as many tasks as it has splits (text, cut at closing braces).

    A piece's part in the text depends on all before it in three sums: of
    quotes (odd: it begins in a string), of brackets outside strings (where
    the depth comes back to one, a report ends) and of ended reports (the
    number of a report). A task adds them up along its split in one pass
    (``json_arrays``) from what the splits before leave, one row a split; these
    are only looked at in files of several splits. Reports cut by the end of a
    split meet by their number, the others go straight on. Columns ``file``,
    ``number`` (from 0) and those of a report.
    """
    lines = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    pieces = lines.select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("split"),
        (meta["file_block_length"] < meta["file_size"]).alias("shared"), F.concat("value", F.lit("}")).alias("value"))
    shared = F.col("shared")
    splits = pieces.where(shared).select("file", "split", "value").mapInArrow(json_arrays.profiles, json_arrays.PROFILE)
    splits = _carried(splits, F.col("quotes"), "before")
    side = (F.col("before") % 2).cast("int")                 # the split begins in a string
    splits = _carried(splits.withColumn("side", side), F.get("deeper", F.col("side")), "depth")
    ended = F.map_from_arrays(F.get("levels", F.col("side")), F.get("ends", F.col("side")))
    splits = _carried(splits, F.coalesce(F.try_element_at(ended, 1 - F.col("depth")), F.lit(0)), "number")
    splits = splits.select("file", "split", F.col("before").alias("quotes"), "depth", "number")

    def texts(some: DataFrame) -> DataFrame:
        """One row per split is sent to all tasks, so that pieces stay in order."""
        begun = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("quotes", "depth", "number")]
        return some.join(F.broadcast(splits), ["file", "split"], "left").select("file", "split", "value", *begun) \
            .mapInArrow(json_arrays.reports, json_arrays.REPORTS)

    cut = texts(pieces.where(shared)).where(~F.col("whole")).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("split", "value"))).alias("p"), F.max("ended").alias("ended")) \
        .where("ended")                                      # what follows the last report is the array's end
    cut = cut.select("file", "number", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    whole = texts(pieces).where("whole").select("file", "number", "value").unionByName(cut)
    text = F.regexp_replace("value", r"^[\s,]*\[?\s*(?=\{)", "")
    return whole.select("file", "number", F.from_json(text, REPORT).alias("r")).select("file", "number", "r.*")


def bounded_read(raw: DataFrame, n: int, order: list[str] | None = None, error: Column | None = None) -> DataFrame:
    """S-04: the first ``n`` decodable messages in arrival order; values that
    do not decode are skipped. ``error`` marks the rows with which the source
    reports an error (a partition that ended, a lost broker): the first of them
    ends the read, and it and all that arrived after it are absent. Its place
    is a scalar, known before the rows are read, so the leading column of the
    order bounds the scan. ``orderBy().limit()`` is planned as a distributed
    top-k (each task keeps ``n`` rows)."""
    order = order or ["timestamp", "offset", "partition"]
    rows = raw
    if error is not None:
        place = F.struct(*order)
        first = raw.where(F.coalesce(error, F.lit(False))).select(F.min(place)).scalar()
        lead = raw.where(F.coalesce(error, F.lit(False))).select(F.min(order[0])).scalar()
        rows = raw.where(lead.isNull() | ((F.col(order[0]) <= lead) & (place < first)))
    return rows.where(parsed("value").isNotNull()).orderBy(*order).limit(n)


#: Offsets of one partition that a folder of a topic log holds.
LOG_BLOCK = 1 << 16


def write_log(rows: DataFrame, path: str, block: int = LOG_BLOCK) -> None:
    """Topic rows added to files that can be read by offset: a folder for each
    topic, partition and ``block`` of offsets, in offset order, the size of
    each value beside it (for ``log_catalogue``)."""
    sized = rows.withColumn("bytes", F.coalesce(F.octet_length("value"), F.lit(0)).cast("long")) \
        .withColumn("block", F.floor(F.col("offset") / block).cast("long"))
    (sized.repartition("topic", "partition", "block").sortWithinPartitions("topic", "partition", "block", "offset")
     .write.mode("append").partitionBy("topic", "partition", "block").parquet(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The topic rows of a log, with ``block`` and ``bytes``; a filter on
    topic, partition or block leaves out whole folders."""
    return spark.read.parquet(path).withColumns({
        "topic": F.col("topic").cast("string"), "partition": F.col("partition").cast("int"),
        "block": F.col("block").cast("long")})


def log_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """S-06 by folder: records, first and last offset and bytes of each block;
    no value is read."""
    return (read_log(spark, path).groupBy("topic", "partition", "block")
            .agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("min_offset"),
                 F.max("offset").alias("max_offset"), F.sum("bytes").alias("bytes")))


def log_range(spark: SparkSession, path: str, topic: str, partition: int, offset: int, max_bytes: int,
              block: int = LOG_BLOCK) -> DataFrame:
    """S-05 from a log: only folders that can hold a record of the answer are
    opened. The first is the offset's; the last is where the bytes of the
    whole blocks after the first reach the bound, taken from the sizes of the
    one partition (two numbers reach the driver)."""
    first = offset // block
    rows = read_log(spark, path).where((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("block") >= first))
    sizes = rows.groupBy("block").agg(F.sum(F.when(F.col("offset") >= offset, F.col("bytes")).otherwise(0)).alias("bytes"))
    upto = sizes.withColumn("upto", F.sum("bytes").over(Window.orderBy("block")))   # one row a block
    last = upto.where(F.col("upto") > max_bytes).agg(F.min("block")).first()[0]
    if last is not None:
        rows = rows.where(F.col("block") <= last)
    return offset_range(rows.drop("block", "bytes"), topic, partition, offset, max_bytes)


def offset_range(raw: DataFrame, topic: str, partition: int, offset: int, max_bytes: int) -> DataFrame:
    """S-05: records of one topic partition from ``offset`` on, in offset order,
    while their running byte total stays within ``max_bytes``. The running
    sum uses the skew-safe ordered helper (one partition can be huge) and
    passes only the segments that start within the bound. A record without a value (a tombstone) counts no bytes and is returned."""
    rows = raw.where((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") >= offset))
    size = F.coalesce(F.octet_length("value"), F.lit(0)).cast("long")
    return ordering.running(rows, [], ["offset"], size, "running_bytes", at_most=F.lit(max_bytes))


def topic_catalogue(raw: DataFrame) -> DataFrame:
    """S-06: per topic and partition, record count and offset range."""
    return (raw.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("min_offset"),
                 F.max("offset").alias("max_offset")))


def boxes_frame(spark: SparkSession, boxes: Iterable) -> DataFrame:
    """Area of interest as a table ``box_id, lat_lo, lat_hi, lng_lo, lng_hi``
    (corners in either order). A table of one's own may have ``lng_lo`` above
    ``lng_hi``: such a box crosses the antimeridian."""
    rows = []
    for i, ((a_lat, a_lng), (b_lat, b_lng)) in enumerate(boxes):
        rows.append((i, float(min(a_lat, b_lat)), float(max(a_lat, b_lat)),
                     float(min(a_lng, b_lng)), float(max(a_lng, b_lng))))
    return spark.createDataFrame(
        rows, "box_id int, lat_lo double, lat_hi double, lng_lo double, lng_hi double")


def _cell(value: Column, low: float, span: float, level: Column | int) -> Column:
    """Number of the row or column of a coordinate at a level, from 0; never
    falling as the coordinate rises, and beyond the globe that of its edge."""
    count = F.lit(float(1 << level)) if isinstance(level, int) else F.pow(F.lit(2.0), level)
    at = F.floor((value - F.lit(low)) / F.lit(span) * count)
    return F.least(F.greatest(at, F.lit(0)), count - 1).cast("long")


def _cell_id(row: Column, column: Column) -> Column:
    return F.shiftleft(row, 32).bitwiseOR(column)


def cover_cells(boxes: DataFrame) -> DataFrame:
    """``level, cell, inside, lat_lo, lat_hi, lng_lo, lng_hi``: the cells that
    cover the boxes. A cell ``inside`` a box (between its first and last row
    and column) needs no further check, and is listed once however many boxes
    hold it; the others come with the bounds of their box."""
    west = F.struct(F.col("lng_lo").alias("lo"), F.lit(180.0).alias("hi"))
    east = F.struct(F.lit(-180.0).alias("lo"), F.col("lng_hi").alias("hi"))
    own = F.struct(F.col("lng_lo").alias("lo"), F.col("lng_hi").alias("hi"))
    parts = boxes.select("lat_lo", "lat_hi", F.explode(
        F.when(F.col("lng_lo") > F.col("lng_hi"), F.array(west, east)).otherwise(F.array(own))).alias("p")) \
        .select("lat_lo", "lat_hi", F.col("p.lo").alias("lng_lo"), F.col("p.hi").alias("lng_hi")).distinct()
    level = F.lit(COVER_LEVELS[0])
    for finer in COVER_LEVELS[1:]:
        high = _cell(F.col("lat_hi"), -90.0, 180.0, finer) - _cell(F.col("lat_lo"), -90.0, 180.0, finer)
        wide = _cell(F.col("lng_hi"), -180.0, 360.0, finer) - _cell(F.col("lng_lo"), -180.0, 360.0, finer)
        level = F.when((high < CELLS_ACROSS) & (wide < CELLS_ACROSS), F.lit(finer)).otherwise(level)
    placed = parts.withColumn("level", level)
    ends = {f"{side}{end}": _cell(F.col(f"{name}_{edge}"), low, span, F.col("level"))
            for side, name, low, span in (("r", "lat", -90.0, 180.0), ("c", "lng", -180.0, 360.0))
            for end, edge in ((0, "lo"), (1, "hi"))}
    cells = placed.withColumns(ends).withColumn("r", F.explode(F.sequence("r0", "r1"))) \
        .withColumn("c", F.explode(F.sequence("c0", "c1")))
    inside = (F.col("r") > F.col("r0")) & (F.col("r") < F.col("r1")) & (F.col("c") > F.col("c0")) & (F.col("c") < F.col("c1"))
    bounds = [F.when(~inside, F.col(b)).alias(b) for b in ("lat_lo", "lat_hi", "lng_lo", "lng_hi")]
    return cells.select("level", _cell_id(F.col("r"), F.col("c")).alias("cell"), inside.alias("inside"), *bounds).distinct()


def area_filter(df: DataFrame, boxes: DataFrame, lat: str = "Lat", lng: str = "Lng") -> DataFrame:
    """S-07: keep reports inside any box (edges inclusive; a box whose
    ``lng_lo`` is above its ``lng_hi`` crosses the antimeridian).

    The boxes are covered by cells of a few levels, and a report looks up its
    own cell of each level: equality joins on the cell, one for each level, that
    only mark the report, in one pass over the reports. Spark sends the cells to
    all tasks where they are few, and deals both sides by cell where they are
    many; the plan is the same, and no report meets a box far from it.
    """
    cells = cover_cells(boxes)
    outs = [F.col(c) for c in df.columns]
    marks = {f"_c{v}": _cell_id(_cell(F.col(lat), -90.0, 180.0, v), _cell(F.col(lng), -180.0, 360.0, v)) for v in COVER_LEVELS}
    found = " OR ".join(
        f"EXISTS (SELECT 1 FROM {{cells}} c WHERE c.level = {v} AND c.cell = d._c{v} AND (c.inside OR "
        f"(d.`{lat}` BETWEEN c.lat_lo AND c.lat_hi AND d.`{lng}` BETWEEN c.lng_lo AND c.lng_hi)))" for v in COVER_LEVELS)
    return df.sparkSession.sql(f"SELECT * FROM {{rows}} d WHERE {found}", rows=df.withColumns(marks), cells=cells).select(*outs)


def mmsi_filter(df: DataFrame, mmsis: Sequence[str] | DataFrame, col: str = "MMSI") -> DataFrame:
    """S-08: vessel subscription. A list becomes an ``isin`` predicate (pushed
    to the scan); a table is a left-semi equi-join (broadcast when small)."""
    if isinstance(mmsis, DataFrame):
        return df.join(mmsis.select(F.col(mmsis.columns[0]).cast("string").alias(col)),
                       col, "left_semi")
    return df.where(F.col(col).cast("string").isin([str(m) for m in mmsis]))


def type_filter(df: DataFrame, types: Sequence[str], col: str = "MessageType") -> DataFrame:
    """S-09: message-type subscription (exact names)."""
    return df.where(F.col(col).isin(list(types)))
