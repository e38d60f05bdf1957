"""What lies on disk while a job runs: no more than its largest step needs."""

import os
import re

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from shipflux import config
from shipflux.functions import keyed
from shipflux.operators import report, sinks
from shipflux.plans import jobs, points
from shipflux.session import discard, prepare_session, shares, staged


def shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}


def eventually(found, wanted) -> bool:
    import time

    return any(found() == wanted or time.sleep(0.1) for _ in range(100))


def test_shuffled_rows_go_when_the_query_ends(spark, tmp_path):
    prepare_session(spark)
    before = shuffle_files(spark)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("total"))
    sums.write.parquet(str(tmp_path / "sums"))
    assert eventually(lambda: shuffle_files(spark) - before, set())
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, sums.collect()))


def test_rows_are_dealt_to_many_partitions_unless_the_session_says_otherwise(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        prepare_session(spark)
        assert int(spark.conf.get(name)) >= 1000
        spark.conf.set(name, "33")
        prepare_session(spark)
        assert spark.conf.get(name) == "33"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_staged_tables_are_removed_and_others_stay(spark):
    gone, kept = staged(spark.range(3), "disk-gone"), staged(spark.range(4), "disk-kept")
    discard(gone.union(kept), "disk-gone", "disk-none")
    folder = re.match(r"file:(?://)?(.*/disk-gone-[0-9a-f]{32})", gone.inputFiles()[0])[1]
    assert not os.path.exists(folder) and kept.count() == 4


def test_shares_hold_every_row_once_also_without_a_month(spark):
    rows = spark.range(200).select("id", F.when(F.col("id") % 9 > 0, (F.col("id") % 9).cast("string")).alias("year_month"))
    parts = [[tuple(row) for row in part.collect()] for part in shares(rows, ("year_month",), 4)]
    assert sorted(row[0] for part in parts for row in part) == list(range(200))
    months = [{row[1] for row in part} for part in parts]
    assert sum(map(len, months)) == len(set().union(*months)) == 9


def test_a_table_written_in_rounds_replaces_the_same_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(300).select(
        "id", (F.col("id") % 5).alias("mmsi"), F.lit("v1").alias("version"), F.concat(F.lit("m"), F.col("id") % 11).alias("year_month")
    )
    sinks.write_partitions(rows.withColumn("id", F.col("id") + 1000), path, ("version", "year_month"), ("mmsi",))
    sinks.write_partitions(rows.filter("year_month <> 'm3'"), path, ("version", "year_month"), ("mmsi",), rounds=4)
    found = sorted(tuple(row) for row in spark.read.parquet(path).select("id", "year_month").collect())
    old = [(n + 1000, "m3") for n in range(300) if n % 11 == 3]
    assert found == sorted([(n, f"m{n % 11}") for n in range(300) if n % 11 != 3] + old)
    sinks.compact(spark, path, ("version", "year_month"), ("mmsi",), rounds=3)
    assert sorted(tuple(row) for row in spark.read.parquet(path).select("id", "year_month").collect()) == found


def test_rounds_read_their_months_only(spark, sf_dir):
    """The share reaches the positions, so nothing is computed for the months of other rounds."""
    facts = q.facts(spark, sf_dir).withColumn("year_month", F.date_format("date_time_utc", "yyyy-MM"))
    plan = shares(facts, ("year_month",), 4)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") > plan.index("Window")


def test_voyages_meet_positions_before_their_facts(spark, sf_dir):
    """Wide facts are not shuffled by ship and month; the rows are those of the facts joined to voyages."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = keyed.small_side.__defaults__, {name: spark.conf.get(name, None) for name in names}
    rows, found = q.positions(spark, sf_dir), q.lookups(spark, sf_dir)
    try:
        keyed.small_side.__defaults__ = (0,)
        for name in names:
            spark.conf.set(name, "-1")
        plan = jobs.calculated_voyages(rows, rows, found)._jdf.queryExecution().executedPlan().toString()
    finally:
        keyed.small_side.__defaults__ = before[0]
        for name, value in before[1].items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "year_month" not in "".join(re.findall(r"Exchange hashpartitioning\((.*?), \d+\), ", plan))


@pytest.mark.parametrize("odd", [False, True])
def test_calculated_voyages_are_the_joined_facts(spark, sf_dir, odd):
    """Also where voyages come twice for a time, lack one, or differ from the position, and where keys are NULL."""
    rows, found = q.positions(spark, sf_dir), q.lookups(spark, sf_dir)
    voyages = rows
    if odd:
        some = F.pmod(F.xxhash64("id"), F.lit(10))
        rows = rows.withColumn("mmsi", F.when(some != 4, F.col("mmsi")))
        voyages = rows.filter(some > 1).union(rows.filter(some > 7).withColumn("delta_previous_point_seconds", F.lit(7).cast("long")))
    stamp = F.lit("2024-06-01").cast("timestamp")
    facts = points.emission_facts(rows, found, stamp=stamp)
    joined = report.join_voyages(report.report_facts(facts, config.VERSION), report.report_voyages(voyages))
    calculated = jobs.calculated_voyages(rows, voyages, found, stamp=stamp)
    columns = sorted(set(joined.columns) - {"unlocode_country_code", "unlocode_location_code"})
    assert sorted(calculated.columns) == columns
    wanted, got = ([tuple(map(repr, row)) for row in df.select(*columns).collect()] for df in (joined, calculated))
    assert wanted and sorted(got) == sorted(wanted)
