"""Line dedup: lines that stand in several documents stay in one of them.
DataFrame functions only.

Levelled runs: documents come in batches, from the largest ids to the
smallest. The lines of a batch are hashed and counted by hash; what a merge
anti-join with the runs so far leaves is new, and is added as a sorted run of
its own (a table bucketed and sorted by the hash, so that neither the runs nor
their joins are ever dealt out again). The rest was seen before and adds to
the counts. Before a batch, each level of ``fan`` runs is compacted to one run
of the next level, so a batch meets few runs however many there were.

As the first batch that has a line holds it in its largest document, a run
knows the one document that keeps the line; counts are documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import cut, pick, written
from tidewater.session import checkpoint_root

BLANKS = " \t\n\x0b\f\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows without a doc_id are one document, before all others.
NO_ID = -(1 << 63)
#: Parts in which the occurrences of one line meet the lines to drop.
SALTS = 16


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, CAPITALS, SMALL))


def hashed(text: Column) -> Column:
    """128 bits of the SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


class LineRuns:
    """Sorted runs (line, holder, docs) in levels; every line is in one run.

    ``add`` takes the lines of a batch of documents, ``repeated`` gives the
    lines of at least so many documents. Batches must come from the largest
    documents to the smallest, and a document's rows in one batch. The runs
    are external tables under the shared folder, so they outlive executors;
    ``close`` forgets the tables.
    """

    def __init__(self, spark: SparkSession, fan: int = 2):
        self.spark, self.fan = spark, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.again: list[str] = []
        self._tables: list[str] = []

    def _sorted(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        rows.write.bucketBy(self.buckets, "line").sortBy("line") \
            .option("path", f"{checkpoint_root(self.spark)}/{name}").saveAsTable(name)
        self._tables.append(name)
        return name

    def runs(self) -> Iterable[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _compact(self) -> None:
        """Merge each full level into one run of the next: runs share no line."""
        for at, level in enumerate(self.levels):
            if len(level) >= self.fan:
                if at + 1 == len(self.levels):
                    self.levels.append([])
                whole = reduce(DataFrame.unionByName, map(self.spark.table, level))
                self.levels[at + 1].append(self._sorted(whole.repartition(self.buckets, "line")))
                self.levels[at] = []

    def add(self, lines: DataFrame) -> None:
        """lines: (line, doc) of the batch's documents, repeats included."""
        self._compact()
        counted = lines.select("line", "doc").distinct().groupBy("line").agg(
            F.max("doc").alias("holder"), F.count(F.lit(1)).alias("docs"))
        batch = self.spark.table(self._sorted(counted.repartition(self.buckets, "line")))
        new = batch
        for run in self.runs():
            new = new.join(run, "line", "left_anti")
        own = self._sorted(new)
        self.again.append(self._sorted(batch.join(self.spark.table(own), "line", "left_anti")))
        self.levels = self.levels or [[]]
        self.levels[0].append(own)

    def repeated(self, least_docs: int) -> DataFrame:
        """(line, holder) of the lines in at least ``least_docs`` documents."""
        if not self.again:
            return self.spark.createDataFrame([], "line binary, holder bigint")
        more = reduce(DataFrame.unionByName, map(self.spark.table, self.again)) \
            .groupBy("line").agg(F.sum("docs").alias("more")).repartition(self.buckets, "line")
        found = [run.join(more, "line", "left").where(F.col("docs") + F.coalesce("more", F.lit(0)) >= least_docs)
                 .select("line", "holder") for run in self.runs()]
        return cut(reduce(DataFrame.unionByName, found))

    def close(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables = []


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, batches: int = 4,
                        fan: int = 2) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every row: the text without the
    lines that stand in at least ``least_docs`` documents, but for the largest
    doc_id among them.

    A text is cut at \\n (null or empty: one empty line). Lines are the same
    if they agree without the blanks at their ends and with A-Z in lower case;
    shorter ones than ``least_chars`` code points stay. Kept lines are joined
    by \\n; if none is kept, the text is empty.

    Rows that share a doc_id are one document, and so are all rows without
    one, which count as smaller than any doc_id. A document that repeats a line
    counts once; the document that holds a line keeps all its lines of it.
    Repeated rows each give a row. An empty table gives an empty result; other
    columns are ignored. ``batches`` ranges of doc_ids of like size are added to the runs one by
    one; the result does not depend on their number, nor on ``fan``.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    docs = pick(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), text.alias("text"))
    cuts = docs.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 1000).alias("x")).first()["x"] \
        if batches > 1 else []
    batch = reduce(lambda n, c: n + F.when(F.col("doc") <= F.lit(c), 1).otherwise(0), sorted(set(cuts or [])), F.lit(0))
    keys = docs.select(batch.alias("batch"), "doc", hashed(F.col("text")).alias("row"),
                       F.posexplode(lines_of(lowered(F.col("text")))).alias("pos", "key")) \
        .withColumn("key", F.trim("key", F.lit(BLANKS))).where(F.char_length("key") >= least_chars) \
        .select("batch", hashed(F.col("key")).alias("line"), "doc", "row", "pos")
    lines = written(keys, "lines")

    runs = LineRuns(spark, fan)
    for n in range(len(set(cuts or [])) + 1):
        runs.add(lines.where(F.col("batch") == n).select("line", "doc"))
    repeated = runs.repeated(least_docs)
    runs.close()

    # a line may stand in any number of documents: its occurrences are dealt in parts
    salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.spark_partition_id() + F.col("pos") + F.xxhash64("doc", "row"), F.lit(SALTS)).cast("int")
    dropped = lines.withColumn("salt", part).join(salted, ["line", "salt"]).where(F.col("doc") != F.col("holder")) \
        .groupBy("doc", "row").agg(F.collect_set("pos").alias("dropped"))
    cuttable = docs.withColumn("row", hashed(F.col("text"))).join(dropped, ["doc", "row"], "left") \
        .select("doc_id", "text", "dropped", lines_of(F.col("text")).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    return cuttable.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text"))
         .otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")).alias("kept"))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: The contract's columns in DuckDB, for the production parameters.
ORACLE_SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
line AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM base),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{CAPITALS}', '{SMALL}') AS key
  FROM line),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
fate AS (
  SELECT k.*, coalesce(k.doc_id <> p.holder, FALSE) AS dropped FROM keyed k LEFT JOIN repeated p ON k.key = p.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM fate GROUP BY r"""
