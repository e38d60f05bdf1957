import pytest
from pyspark.sql import functions as F

from shipflux.functions.cells import parent_cell
from shipflux.functions.cleaning import day_month_year, decimal_comma, spaced_int
from shipflux.functions.keyed import keep_first, measured_bytes, small_side
from shipflux.functions.rules import Rule, bands, decide
from shipflux.operators import parameters, register


def test_known_parent_cell(spark):
    cells = spark.createDataFrame([(0x85283473FFFFFFF,)], "cell long")
    assert cells.select(parent_cell(F.col("cell"), 0)).first()[0] == 0x8029FFFFFFFFFFF


def test_first_rule_wins_and_null_matches_nothing(spark):
    rules = [Rule({"a": ("x", "y")}, "first"), Rule({"a": "x", "b": 1}, "second"), Rule({"b": 2}, "third")]
    rows = spark.createDataFrame([("x", 1), ("z", 2), (None, 2), (None, None)], "a string, b int")
    text = decide(rules, {"a": "a", "b": "b"})
    assert [r[0] for r in rows.select(F.expr(text)).collect()] == ["first", "third", "third", None]


@pytest.mark.parametrize(
    "value, label",
    [(None, "Unknown"), (-99.0, "Unknown"), (0.0, "Unknown"), (0.5, "gt1, 0-399"), (399.9, "gt1, 0-399"),
     (400.0, "gt2, 400-999"), (99999.0, "gt8, 50000-99999"), (100000.0, "gt9, >=100 000")],
)
def test_band_edges(spark, value, label):
    rows = spark.createDataFrame([(value,)], "gt double")
    text = bands("gt", *register.GT_GROUPS, "Unknown", above_first=True)
    assert rows.select(F.expr(text)).first()[0] == label


def test_cleaning_keeps_going_on_bad_text(spark):
    rows = spark.createDataFrame([("12,5", "1 200", "31.01.2024"), ("x", "n/a", "31.02.2024")], "a string, b string, c string")
    found = rows.select(
        decimal_comma(F.col("a")), spaced_int(F.col("b")), day_month_year(F.col("c")).cast("string")
    ).collect()
    assert [tuple(row) for row in found] == [(12.5, 1200, "2024-01-31"), (None, None, None)]


def test_parameter_names_and_missing_names(spark):
    names = parameters.required_names()
    assert len(names) == len(set(names)) == 323
    with pytest.raises(KeyError, match="2 emission parameters are missing: bc_aux_distillate_fuel, cf_lng"):
        parameters.Parameters({n: 1.0 for n in names if n not in ("cf_lng", "bc_aux_distillate_fuel")})
    table = spark.createDataFrame([(n,) for n in names if n != "cf_lng"], "variable string")
    assert [row[0] for row in parameters.missing_names(table, names).collect()] == ["cf_lng"]


def test_keep_first_cuts_groups_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    first = keep_first(rows, ["k"], [F.col("v").desc()])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(tuple(r) for r in first.collect()) == [(0, 999), (1, 997), (2, 998)]


def test_side_above_the_limit_is_not_broadcast(spark):
    side = spark.range(100).groupBy("id").count()
    wide = spark.range(1000)
    hinted = wide.join(small_side(side), "id")
    unhinted = wide.join(small_side(side, limit=10), "id")

    def logical(df):
        return df._jdf.queryExecution().analyzed().toString()

    assert "broadcast" in logical(hinted) and "broadcast" not in logical(unhinted)
    assert hinted.count() == unhinted.count() == 100


def test_a_side_that_is_written_again_is_measured_again(spark, tmp_path):
    """The measure belongs to the files, not to their folder."""
    path = str(tmp_path / "side")
    spark.range(10).write.parquet(path)
    small = measured_bytes(spark.read.parquet(path))
    spark.range(100_000).write.mode("overwrite").parquet(path)
    assert measured_bytes(spark.read.parquet(path)) == 10_000 * small
    joined = spark.range(5).join(small_side(spark.read.parquet(path), limit=1000), "id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
