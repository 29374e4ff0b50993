"""Physical-plan checks: single JSON parse, broadcast semi join for the
area filter, no cartesian products, ordered helpers without a global sort
of the rows."""

import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from tidewater.plans.queries import all_queries
from conftest import SF_MID, SF_SMALL

QUERIES = all_queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_decode_parses_value_once(spark):
    plan = _optimized(QUERIES["d01_decode_reports"](spark, SF_SMALL))
    assert plan.count("from_json(") == 1


def test_area_filter_looks_up_cells(spark):
    """Marks by equality, one read of the reports, no nested loop: with few boxes and, by cell, with many."""
    from tidewater.sources import topics
    plan = _plan(QUERIES["s07_area_filter"](spark, SF_SMALL))
    assert "NestedLoop" not in plan and plan.count("ExistenceJoin") == len(topics.COVER_LEVELS)
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 1
    many = spark.range(1000).selectExpr("id * 0.1D - 50 AS lat_lo", "id * 0.1D - 49.9 AS lat_hi", "-1D AS lng_lo", "1D AS lng_hi")
    points = spark.range(1000).selectExpr("id * 0.17D - 85 AS Lat", "id * 0.001D AS Lng")
    with_merge = topics.area_filter(points, many.hint("merge"))
    assert "NestedLoop" not in _plan(with_merge)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_product(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("key", ["w02_change_status", "a06_cumulative_rate", "w04_keyed_collect",
                                 "s05_offset_range", "w05_flush_batches"])
def test_ordered_helpers_avoid_single_partition_row_sort(spark, key):
    df = QUERIES[key](spark, SF_MID)
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    # a single-partition exchange may only carry aggregates or one row a span
    for i in singles:
        below = lines[i + 1:i + 12]
        assert any("Aggregate" in line or "Filter isnull(_next" in line for line in below), "\n".join(below)


#: Reads of the source and hash exchanges of rows and summaries, reused ones
#: not counted; one more read where the first arrival is asked for.
LIMITS = {"w04_keyed_collect": (2, 5), "a06_cumulative_rate": (3, 4), "a07_interval_stats": (1, 2),
          "w02_change_status": (2, 6), "s05_offset_range": (2, 4), "w05_flush_batches": (2, 7)}


@pytest.mark.parametrize("key", sorted(LIMITS))
def test_ordered_queries_read_and_shuffle_little(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    reads, shuffles = LIMITS[key]
    assert final.count("FileScan") <= reads, final
    assert len(re.findall(r"[^d]Exchange hashpartitioning", final)) <= shuffles, final


def test_log_range_opens_only_the_folders_it_needs(spark, scratch):
    from tidewater.sources import topics
    rows = spark.range(4000).selectExpr("CAST(NULL AS STRING) AS key", "repeat('x', 10) AS value", "'t' AS topic", "CAST(id % 2 AS INT) AS partition",
                                        "id div 2 AS offset", "timestamp_seconds(id) AS timestamp")
    topics.write_log(rows, f"{scratch}/log", block=100)
    got = topics.log_range(spark, f"{scratch}/log", "t", 1, 350, 1495, block=100)
    assert sorted(r["offset"] for r in got.collect()) == list(range(350, 499))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    got = topics.log_range(spark, f"{scratch}/log", "t", 1, 350, 1495, block=100)
    filters = re.findall(r"PartitionFilters: \[[^\]]*\]", _plan(got))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert filters and all(re.search(r"block#\d+L? >= 3\b", f) and re.search(r"block#\d+L? <= 4\b", f) for f in filters)
