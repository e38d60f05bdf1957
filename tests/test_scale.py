"""Busy groups and plans: what has to hold when one group has a third of all rows."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import queries as q
from shipflux.operators import areas, report, voyages
from shipflux.plans import points


def test_voyage_ends_equal_windows_with_a_third_of_rows_without_voyage(spark):
    ids = spark.range(3000)
    rows = ids.select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("sail_id"),
        (F.col("id") % 17).alias("mmsi"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 7 % 6).cast("string")).alias("municipality_id"),
        F.timestamp_seconds(F.col("id") * 7919 % 500).alias("date_time_utc"),
        (F.col("id") % 11 == 0).alias("ship_is_stopped"),
        "id",
    )
    towns = spark.createDataFrame([(str(n), f"Town {9 - n}") for n in range(5)], "municipality_no string, municipality_name string")
    found = voyages.with_voyages(rows, voyages.voyage_ends(voyages.voyage_parts(rows)), towns)

    order = ["date_time_utc", "mmsi", "municipality_id"]
    whole = Window.partitionBy("sail_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    brute = rows.select(
        "id",
        F.first("municipality_id").over(whole).alias("start"),
        F.last("municipality_id").over(whole).alias("end"),
        (F.count("*").over(Window.partitionBy("sail_id", "municipality_id")) == F.count("*").over(Window.partitionBy("sail_id"))).alias("local"),
    )
    both = found.join(brute, "id")
    wrong = both.filter(
        ~F.col("start").eqNullSafe(F.col("municipality_id_start"))
        | ~F.col("end").eqNullSafe(F.col("municipality_id_end"))
        | (F.col("local") & ~F.col("municipality_voyage_type").isin("Local", "Berthed"))
        | (~F.col("local") & (F.col("municipality_voyage_type") == "Local"))
    )
    assert both.count() == 3000 and wrong.count() == 0


def test_duplicates_of_one_time_collapse_to_one_row(spark, sf_dir):
    one = q.positions(spark, sf_dir).limit(1)
    numbered = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(500))).alias("n"))
    copies = numbered.withColumn("id", F.lpad(F.col("n").cast("string"), 4, "0"))
    rows = copies.withColumn("period_start", F.lit("2000-01-01").cast("date"))
    kept = points.one_per_time(rows).select("id").collect()
    assert [row[0] for row in kept] == ["0001"]


def test_overlapping_periods_and_rings_do_not_multiply_positions(spark, sf_dir):
    rows = areas.with_parent_cells(q.positions(spark, sf_dir))
    joined = areas.join_shore_power(rows, q.lookups(spark, sf_dir).nearest_shore_power)
    assert joined.count() == rows.count()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_shuffle_positions_once(spark, sf_dir):
    plan = executed(q.facts(spark, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.count("WindowGroupLimit") == 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_results_are_the_same_without_broadcasts(spark, sf_dir):
    """Above the broadcast limit every lookup join becomes a shuffle join with the same rows."""
    names = ("id", "municipality_id", "shore_power_id", "fuel_tonnes", "co2e_tonnes")
    wanted = sorted(map(tuple, q.facts(spark, sf_dir).select(*names).collect()), key=repr)
    from shipflux.functions import keyed

    limit, threshold = keyed.small_side.__defaults__, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        keyed.small_side.__defaults__ = (0,)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = q.facts(spark, sf_dir).select(*names)
        assert "BroadcastHashJoin" not in executed(shuffled)
        assert sorted(map(tuple, shuffled.collect()), key=repr) == wanted
    finally:
        keyed.small_side.__defaults__ = limit
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_date_range_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "facts")
    facts = spark.range(10).select(
        F.lit("v1.5.0").alias("version"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date_utc")
    ).withColumn("date_time_utc", F.col("date_utc").cast("timestamp"))
    facts.write.partitionBy("version", "date_utc").parquet(path)
    wanted = report.in_dates(spark.read.parquet(path), "2024-01-03", "2024-01-04")
    plan = executed(wanted)
    assert re.search(r"PartitionFilters: \[[^\]]*date_utc", plan) and re.search(r"PushedFilters: \[[^\]]*date_time_utc", plan)
    assert wanted.count() == 2


def test_report_sums_equal_fact_sums(spark, sf_dir):
    rows = q.voyage_facts(spark, sf_dir).agg(F.sum("co2_tonnes"), F.sum("delta_previous_point_seconds")).first()
    sums = q.full_report(spark, sf_dir).agg(F.sum("sum_co2"), F.sum("sum_seconds")).first()
    assert abs(rows[0] - sums[0]) < 1e-6 * abs(rows[0]) and rows[1] == sums[1]
