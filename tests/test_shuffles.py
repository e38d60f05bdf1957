"""What is shuffled when no lookup is small enough to be broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from checks import io_queries
from checks import queries as q
from shipflux import config
from shipflux.functions import keyed
from shipflux.operators import report
from shipflux.plans import points
from shipflux.session import SHUFFLED_PARTITION, UNASKED_BROADCAST, prepare_session
from shipflux.streaming import scd


@pytest.fixture
def no_broadcasts(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = keyed.small_side.__defaults__, {name: spark.conf.get(name, None) for name in names}
    keyed.small_side.__defaults__ = (0,)
    for name in names:
        spark.conf.set(name, "-1")
    yield
    keyed.small_side.__defaults__ = before[0]
    for name, value in before[1].items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hashed(df) -> list[str]:
    """Columns of every hash exchange, without expression ids."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\), ", plan)]


def test_report_rows_are_shuffled_by_ship_alone(spark, sf_dir, no_broadcasts):
    keys = hashed(q.full_report(spark, sf_dir))
    assert keys.count("_ship") == 2  # all columns once, and the pairs of ship and voyage
    assert not [key for key in keys if key.startswith(("vessel_id", "coalesce(sail_id", "mmsi"))]


def test_joined_facts_are_not_shuffled_again_for_the_sums(spark, sf_dir, no_broadcasts):
    facts = q.stored(spark, sf_dir, "facts-of-shuffles", lambda: q.facts(spark, sf_dir))
    joined = report.join_voyages(report.report_facts(facts, config.VERSION), report.report_voyages(q.positions(spark, sf_dir)))
    rows = report.pre_aggregate(joined.withColumn("period_start", F.lit(None).cast("date")))
    assert hashed(rows) == ["mmsi, year_month", "mmsi, year_month"]


def test_port_usage_meets_positions_where_their_ship_is(spark, sf_dir, no_broadcasts):
    found = q.lookups(spark, sf_dir)
    rows = points.attach_vessels(q.one_per_time(spark, sf_dir), found.factors).withColumn("municipality_id", F.lit("0301"))
    usage = F.broadcast(found.vessel_port_usage).hint("merge")
    joined = rows.join(usage.drop("mmsi"), (rows["vessel_id"] == usage["vessel_id"]) & (F.col("municipality_id") == F.col("municipality_no")), "left")
    keys = hashed(joined)
    assert not [key for key in keys if "municipality" in key or "period_start" in key]


def test_rows_without_a_ship_keep_their_voyage(spark, sf_dir):
    rows = q.stored(
        spark, sf_dir, "rows-of-shuffles",
        lambda: report.report_rows(
            report.report_facts(q.facts(spark, sf_dir), config.VERSION), report.report_voyages(q.positions(spark, sf_dir)),
            q.vessels(spark, sf_dir),
        ),
    )
    inputs = q.report_inputs(spark, sf_dir)
    names = ("mmsi", "sail_id", "municipality_voyage_type", "municipality_voyage_route", "sum_co2")
    with_ships = report.emission_report(rows, *inputs).select(*names)
    nobody = report.emission_report(rows.withColumn("vessel_id", F.lit(None).cast("int")), *inputs)
    assert nobody.filter("imo IS NOT NULL OR shipname IS NOT NULL OR vessel_id IS NOT NULL").count() == 0
    kinds = ("municipality_voyage_type", "municipality_voyage_route")
    wanted = {tuple(row[:2]): row[2] for row in with_ships.groupBy(*kinds).agg(F.sum("sum_co2")).collect()}
    found = {tuple(row[:2]): row[2] for row in nobody.groupBy(*kinds).agg(F.sum("sum_co2")).collect()}
    assert found == pytest.approx(wanted)


def test_scattered_rows_take_as_many_tasks_as_their_size_asks_for(spark, sf_dir):
    assert hashed(io_queries.scattered(q.positions(spark, sf_dir))) != []


def test_files_of_some_megabytes_are_not_broadcast_unasked(spark, tmp_path):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        for given, wanted in (("10485760b", UNASKED_BROADCAST), ("10m", UNASKED_BROADCAST), ("256k", "256k"), ("-1", "-1")):
            spark.conf.set(limit, given)
            prepare_session(spark)
            assert spark.conf.get(limit) == str(wanted)
        spark.conf.set(limit, "10m")
        prepare_session(spark)
        names = spark.range(500_000).select("id", F.xxhash64("id").alias("code"))
        names.write.parquet(str(tmp_path / "names"))
        joined = spark.range(1_000_000).join(spark.read.parquet(str(tmp_path / "names")), "id")
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)


def test_shuffled_partitions_stay_small_enough_for_a_task(spark):
    """Partitions are joined up to the limit only, which a session may set lower."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        for given, wanted in (("67108864b", SHUFFLED_PARTITION), ("64MB", SHUFFLED_PARTITION), ("8m", "8m")):
            spark.conf.set(size, given)
            prepare_session(spark)
            assert spark.conf.get(size) == str(wanted)
    finally:
        spark.conf.set(size, before)


def test_versions_are_dealt_by_bucket_once(spark, no_broadcasts):
    """Steps lie by key and bucket once; the last states of the buckets come from there, not from a shuffle of all states."""
    rows = spark.range(100).selectExpr("id % 7 AS k", "id AS value", "timestamp_seconds(id * 40000) AS at")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = scd.scd2(rows, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    steps = [line for line in plan.split("\n") if "hashpartitioning(k#" in line and "REPARTITION_BY_COL" in line]
    assert ["ReusedExchange" in line for line in steps] == [False, True]
