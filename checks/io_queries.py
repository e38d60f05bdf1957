"""Ingest and table-maintenance operators as queries: they write, read back and return what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.queries import (
    SEQUENCE,
    VARIABLE_KEYS,
    fact_inputs,
    facts,
    full_report,
    lookups,
    moment,
    query,
    report_inputs,
    steady,
    steady_sums,
    text,
    written_report,
)
from checks.spark_inputs import derive, given, positions
from shipflux import config, schemas
from shipflux.functions.cleaning import DATE_PATTERN
from shipflux.operators import sinks
from shipflux.plans import jobs, points, views
from shipflux.session import discard, shares, staged, work_folder
from shipflux.sources import csv_drops
from shipflux.streaming import ingest, scd

# Dates of one job range: few ranges, but more than one.
DATES_PER_RANGE = 900
# Dates from here on are processed a second time.
AGAIN = "1998-05-01"
# Months of one report range, and the month that is completed last.
MONTHS_PER_RANGE = 48
LATE_MONTH = "1994-02-01"


def drop_rows(kind: str, rows: DataFrame) -> DataFrame:
    """Rows in the column order of a drop, as text."""
    names = schemas.struct(schemas.DROPS[kind]).names
    return rows.select(*(F.col(name).cast("string").alias(name) for name in names))


def write_drop(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").csv(folder, sep=";", header=True, emptyValue="")


def ingest_drops(spark: SparkSession, kind: str, parts: list[DataFrame], build=None, keys=()) -> DataFrame:
    """Deliver the parts one after the other, with an ingest run after each.

    Returns the bronze table, or with `build` the silver table of these keys that follows it.
    """
    base = work_folder(spark, f"ingest-{kind}")
    for part in parts:
        write_drop(drop_rows(kind, part), f"{base}/drop")
        ingest.ingest(spark, kind, f"{base}/drop", f"{base}/bronze", f"{base}/checkpoint")
        if build:
            ingest.follow(spark, f"{base}/bronze", f"{base}/silver", f"{base}/silver-checkpoint", build, keys)
    return ingest.followed(spark, f"{base}/silver") if build else spark.read.parquet(f"{base}/bronze")


@query
def ingest_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "deliveries")
    early = F.col("bi_ingested_timestamp") < F.lit("1998-01-01").cast("timestamp")
    bronze = ingest_drops(spark, "emission_variables", [rows.filter(early), rows.filter(~early)])
    typed = scd.type_variables(bronze)
    return typed.select("variable", "value", text("start_date"), text("end_date"), F.col("_rescue").isNotNull().alias("rescued"))


@query
def ingest_vessel_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "vessel_types")
    renamed = rows.withColumn("vessel_type", F.concat(F.lit("Old "), "vessel_type"))
    names = ("statcode5", "vessel_type", "bi_ingested_timestamp")
    silver = ingest_drops(
        spark, "vessel_type", [renamed, rows], lambda past: scd.scd1(past.select(*names), names[:1], names[2]), names[:1]
    )
    return silver.select("statcode5", F.nullif("vessel_type", F.lit("")).alias("vessel_type"))


@query
def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries out of order, the last with rows of the first again; each updates the versions of its keys."""
    base = work_folder(spark, "stream-scd2")
    rows = derive(spark, sf_dir, "deliveries")
    third = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    for part in (third == 2, third == 0, third != 0):
        rows.filter(part).write.mode("append").parquet(f"{base}/bronze")
        ingest.follow(
            spark,
            f"{base}/bronze",
            f"{base}/silver",
            f"{base}/checkpoint",
            lambda past: scd.scd2(past, VARIABLE_KEYS, SEQUENCE),
            VARIABLE_KEYS,
            scd.type_variables,
        )
    return ingest.followed(spark, f"{base}/silver").select(
        "variable", text("start_date"), text("end_date"), "value", moment("__START_AT"), moment("__END_AT")
    )


@query
def ingest_aux_boiler(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "bins_raw")
    marred = rows.withColumn("aux_cruise", F.when(F.col("size_bin") == 3, "n/a").otherwise(F.col("aux_cruise").cast("string")))
    bronze = ingest_drops(spark, "vessel_aux_boiler_kw", [marred])
    return bronze.select(
        "vessel_type", "size_bin", "unit", "low_limit", "boiler_berth", "aux_berth",
        F.coalesce("aux_cruise", F.lit(-1)).alias("aux_cruise"), F.col("_rescue").isNotNull().alias("rescued"),
    )


@query
def ingest_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "battery_raw").withColumns(
        {
            "battery_installation_year": F.year("start_date"),
            "battery_pack_kwh": F.concat_ws(" ", F.lit("1"), F.col("battery_pack_kwh")),
        }
    )
    bronze = ingest_drops(spark, "vessel_battery_stream", [rows])
    return bronze.select(
        "mmsi", "route", F.col("degree_of_electrification").cast("double").alias("degree_of_electrification"),
        F.coalesce("battery_pack_kwh", F.lit(-1)).alias("battery_pack_kwh"),
    ).withColumn("degree_of_electrification", steady("degree_of_electrification", 4))


@query
def csv_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "battery_raw").withColumns(
        {name: F.date_format(name, DATE_PATTERN) for name in ("start_date", "end_date")}
    )
    folder = work_folder(spark, "csv-batch")
    write_drop(drop_rows("vessel_battery", rows), folder)
    return csv_drops.read_drop(spark, "vessel_battery", folder).select(
        "mmsi", "imo", "vessel_name", "route", "degree_of_electrification", "battery_pack_kwh",
        text("start_date"), text("end_date"), "bi_source",
    )


def all_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job log in which every date is still to do."""
    days = positions(spark, sf_dir).select("date_utc").distinct()
    return days.select(
        "date_utc", F.col("date_utc").cast("timestamp").alias("ais_voyages"), F.lit(None).cast("timestamp").alias("emission")
    )


def by_date(table: DataFrame) -> DataFrame:
    return table.groupBy("date_utc", "version").agg(
        F.count("*").alias("n_rows"), F.sum("co2_tonnes").alias("co2_tonnes"), F.sum("aux_kwh").alias("aux_kwh")
    ).select(text("date_utc"), "version", "n_rows", steady("co2_tonnes", 5), steady("aux_kwh", 3))


@query
def fact_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact job over all dates, then again with the last months pending once more: they are replaced."""
    path = work_folder(spark, "facts")
    log = all_pending(spark, sf_dir)
    for _ in range(2):
        log = jobs.run_fact_job(
            positions(spark, sf_dir), log, fact_inputs(spark, sf_dir), path, max_dates=DATES_PER_RANGE, spread=1, monthly=True
        )
        log = log.withColumn("emission", F.when(F.col("date_utc") < AGAIN, F.col("emission")))
    return by_date(spark.read.parquet(path))


def version_facts(spark: SparkSession, sf_dir: str, version: str = config.VERSION) -> DataFrame:
    return points.emission_facts(positions(spark, sf_dir), lookups(spark, sf_dir), version)


@query
def purge_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "facts")
    for version in (config.VERSION, "v0.9"):
        sinks.write_facts(version_facts(spark, sf_dir, version), path, 1, monthly=True, rounds=sinks.ROUNDS)
    sinks.purge_version(spark, path, "v0.9")
    return by_date(spark.read.parquet(path))


def scattered(rows: DataFrame) -> DataFrame:
    """Rows of every partition spread over all tasks, so the number of tasks follows their size."""
    return rows.repartition(F.xxhash64("id"))


@query
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts scattered over many small files, then rewritten; the rows stay the same."""
    path = work_folder(spark, "facts")
    day = F.to_date("date_time_utc")
    dated = version_facts(spark, sf_dir).withColumns({"date_utc": day, "year_month": F.date_format(day, "yyyy-MM")})
    for share in shares(dated, ("year_month",), sinks.ROUNDS):
        scattered(share).write.mode("append").partitionBy(*sinks.MONTHLY_FACT_PARTITIONS).parquet(path)
    sinks.compact(spark, path, sinks.MONTHLY_FACT_PARTITIONS, ("date_utc", "mmsi", "date_time_utc"), spread=1)
    return by_date(spark.read.parquet(path))


def by_month(table: DataFrame) -> DataFrame:
    months = table.groupBy("year_month", "version").agg(
        F.count("*").alias("n_rows"), F.sum("sum_seconds").alias("sum_seconds"), F.sum("sum_co2").alias("sum_co2")
    )
    return months.select("year_month", "version", "n_rows", "sum_seconds", steady("sum_co2", 4))


@query
def report_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report, written twice: the months are replaced, not added."""
    path = work_folder(spark, "report")
    for _ in range(2):
        report = full_report(spark, sf_dir)
        sinks.write_report(sinks.with_processing_time(report), path, sinks.REPORT_ROUNDS)
        discard(report, *jobs.REPORT_STAGES)
    return by_month(spark.read.parquet(path))


@query
def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report job over all months in several ranges; one month is completed after later ones are reported."""
    held = staged(facts(spark, sf_dir), "facts")
    start = F.trunc(F.to_date("date_time_utc"), "month")
    months = held.select(start.alias("first")).distinct()
    days = F.explode(F.sequence("first", F.last_day("first"), F.expr("interval 1 day"))).alias("date_utc")
    log = staged(months.select(days, F.lit("2024-06-02").cast("timestamp").alias("emission")), "log")
    late = F.col("date_utc").between(LATE_MONTH, F.last_day(F.lit(LATE_MONTH).cast("date")))
    path, rows = work_folder(spark, "report"), work_folder(spark, "report-rows")
    reported = spark.createDataFrame([], "year_month string, version string, bi_processing_time timestamp")
    for done in (log.filter(~late), log):
        jobs.run_report_job(
            held, positions(spark, sf_dir), done, reported, report_inputs(spark, sf_dir), path, rows,
            months_per_range=MONTHS_PER_RANGE,
        )
        reported = spark.read.parquet(path)
    return by_month(spark.read.parquet(path))


def registered_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A created view over a report on disk, read by its name alone."""
    path = work_folder(spark, "report")
    sinks.write_report(written_report(spark, sf_dir), path, sinks.ROUNDS)
    prefix = f"shipflux_{uuid.uuid4().hex}_"
    views.create_views(spark, f"parquet.`{path}`", prefix)
    return steady_sums(spark.sql(f"SELECT * FROM {prefix}{name}"), 3)


@query
def registered_report_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered_view(spark, sf_dir, "report")


@query
def registered_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered_view(spark, sf_dir, "top_routes")


@query
def purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in two versions, of which one is removed."""
    path = work_folder(spark, "report")
    sinks.write_report(written_report(spark, sf_dir), path, sinks.ROUNDS)
    sinks.purge_version(spark, path, "v0.9")
    return by_month(spark.read.parquet(path))
