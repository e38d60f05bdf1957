"""Slowly changing tables: late rows, repeats, a busy key, partial refresh and restarts."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shipflux.session import work_folder
from shipflux.streaming import ingest, scd

KEYS, SEQUENCE = ["variable", "start_date"], "seq"
SCHEMA = "variable string, start_date string, value double, seq timestamp"


def deliveries(seed: int, count: int) -> list[tuple]:
    """Shuffled deliveries in which one key holds about a third of the rows."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for number in range(count):
        name = "hot" if rng.random() < 0.34 else f"v{rng.randrange(12)}"
        day = None if name == "v3" else "2024-01-01"
        rows.append((name, day, float(rng.randrange(2)), start + dt.timedelta(hours=7 * number)))
    rng.shuffle(rows)
    return rows


def brute_force(rows: list[tuple]) -> list[tuple]:
    found = []
    for key in {row[:2] for row in rows}:
        kept = []
        for row in sorted((r for r in rows if r[:2] == key), key=lambda r: r[3]):
            if not kept or kept[-1][2] != row[2]:
                kept.append(row)
        found += [(*row, later[3] if later else None) for row, later in zip(kept, [*kept[1:], None])]
    return sorted(found, key=repr)


def as_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*KEYS, "value", "__START_AT", "__END_AT").collect()), key=repr)


def test_versions_match_brute_force(spark):
    rows = deliveries(1, 400)
    assert as_rows(scd.scd2(spark.createDataFrame(rows, SCHEMA), KEYS, SEQUENCE)) == brute_force(rows)


def test_one_bucket_gives_the_same_versions(spark):
    rows = deliveries(2, 200)
    found = scd.scd2(spark.createDataFrame(rows, SCHEMA), KEYS, SEQUENCE, bucket=F.lit(0))
    assert as_rows(found) == brute_force(rows)


def followed_files(silver: str) -> dict[str, float]:
    return {str(path): path.stat().st_mtime_ns for path in Path(silver).rglob("*.parquet")}


def follow_variables(spark, base: str):
    def build(past):
        return scd.scd2(past, KEYS, SEQUENCE)

    return ingest.follow(spark, f"{base}/bronze", f"{base}/silver", f"{base}/checkpoint", build, KEYS, buckets=16)


def test_followed_versions_of_late_and_repeated_rows(spark):
    base = work_folder(spark, "follow")
    rows = deliveries(5, 300)
    for part in (rows[200:], rows[:100], rows[50:200]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/bronze")
        follow_variables(spark, base)
    assert as_rows(ingest.followed(spark, f"{base}/silver")) == brute_force(rows)


def test_a_delivery_replaces_the_buckets_of_its_keys_only(spark):
    base = work_folder(spark, "follow")
    rows = deliveries(6, 200)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{base}/bronze")
    follow_variables(spark, base)
    before = followed_files(f"{base}/silver")
    follow_variables(spark, base)
    assert followed_files(f"{base}/silver") == before
    late = [("v1", "2024-01-01", 7.0, dt.datetime(2023, 1, 1))]
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/bronze")
    follow_variables(spark, base)
    after = followed_files(f"{base}/silver")
    changed = {Path(name).parent.name for name, stamp in before.items() if after.get(name) != stamp}
    assert len(changed) == 1 and len({Path(name).parent for name in before}) > 3
    assert as_rows(ingest.followed(spark, f"{base}/silver")) == brute_force(rows + late)


def test_a_delivery_that_failed_is_taken_again(spark):
    """Its rows are kept once, whatever of it was already there."""
    base = work_folder(spark, "follow")
    rows = deliveries(7, 120)
    frame = spark.createDataFrame(rows, SCHEMA)

    def failing(past):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ingest.take_delivery(frame, "first", f"{base}/silver", failing, KEYS, 8)
    for _ in range(2):
        ingest.take_delivery(frame, "first", f"{base}/silver", lambda past: scd.scd2(past, KEYS, SEQUENCE), KEYS, 8)
    assert spark.read.parquet(f"{base}/silver_history").count() == 120
    assert as_rows(ingest.followed(spark, f"{base}/silver")) == brute_force(rows)
    nothing = spark.createDataFrame([], SCHEMA)
    ingest.take_delivery(nothing, "second", f"{base}/silver", lambda past: scd.scd2(past, KEYS, SEQUENCE), KEYS, 8)
    assert as_rows(ingest.followed(spark, f"{base}/silver")) == brute_force(rows)


def test_refresh_of_changed_keys_equals_rebuild(spark):
    rows = deliveries(3, 200)
    old, batch = rows[:150], rows[150:170]
    current = scd.scd2(spark.createDataFrame(old, SCHEMA), KEYS, SEQUENCE)
    bronze = spark.createDataFrame(old + batch, SCHEMA)
    refreshed = scd.scd2_refresh(current, bronze, spark.createDataFrame(batch, SCHEMA), KEYS, SEQUENCE)
    assert as_rows(refreshed) == brute_force(old + batch)


def test_latest_row_per_key(spark):
    rows = deliveries(4, 100)
    found = scd.scd1(spark.createDataFrame(rows, SCHEMA), ["variable"], SEQUENCE)
    latest = {name: max(r[3] for r in rows if r[0] == name) for name in {r[0] for r in rows}}
    assert {r["variable"]: r["seq"] for r in found.collect()} == latest


def test_ingest_takes_each_file_once_and_keeps_bad_rows(spark, tmp_path):
    drop, base = tmp_path / "drop", work_folder(spark, "test-ingest")
    drop.mkdir()
    header = "vessel_type;vessel_type_id;low_limit;high_limit;size_bin;unit;" + ";".join(
        f"{e}_{m}" for e in ("boiler", "aux") for m in ("berth", "anchor", "maneuver", "cruise")
    )
    tail = ";1;2;3;4;5;6;7;8"

    def run() -> int:
        ingest.ingest(spark, "vessel_aux_boiler_kw", str(drop), f"{base}/bronze", f"{base}/checkpoint")
        return spark.read.parquet(f"{base}/bronze").count()

    (drop / "a.csv").write_text(f"{header}\nTug;1;0;10;1;gt{tail}\nTug;1;ten;20;2;gt{tail}\n")
    assert run() == 2
    assert run() == 2
    (drop / "b.csv").write_text(f"{header}\nCruise;2;0;10;1;gt{tail}\n")
    assert run() == 3
    bad = spark.read.parquet(f"{base}/bronze").filter("_rescue IS NOT NULL").collect()
    assert [(r["vessel_type"], r["low_limit"], r["_rescue"]) for r in bad] == [("Tug", None, f"Tug;1;ten;20;2;gt{tail}")]
