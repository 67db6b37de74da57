"""Boundaries of the row-level definitions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake.config import (
    DAILY_METRIC_COLUMNS,
    FACILITY_GROUP,
    HOUR_COLUMNS,
    PROVIDER_FIELDS,
    STAFFING_COLUMNS,
)
from rosterlake.functions import calendar, numeric, staffing
from rosterlake.plans.gold import daily_metrics
from rosterlake.plans.silver import SILVER_COLUMNS


def values(frame, *names):
    return [tuple(row) for row in frame.select(*names).collect()]


@pytest.mark.parametrize(
    ("ratio", "tier"),
    [
        (None, "exclude_zero_census"),
        (0.0, "critical_no_staff"),
        (0.9999, "critical_understaffed"),
        (1.0, "below_cms_minimum"),
        (2.44996, "below_cms_minimum"),
        (2.45, "meets_cms_minimum"),
        (float("nan"), "meets_cms_minimum"),
    ],
)
def test_tier_boundaries(spark, ratio, tier):
    frame = spark.createDataFrame([(ratio,)], "r double")
    assert values(frame.select(staffing.staffing_tier(F.col("r")).alias("t")), "t") == [(tier,)]


@pytest.mark.parametrize(
    ("census", "hours", "tier"),
    [
        (9, 100.0, "exclude_low_census"),
        (0, 0.0, "exclude_low_census"),
        (None, 100.0, "exclude_zero_census"),
        (10, None, "exclude_zero_census"),
        (10, 0.0, "critical_no_staff"),
        (10, 9.0, "critical_understaffed"),
        (10, 24.0, "below_cms_minimum"),
        (10, 24.5, "meets_cms_minimum"),
    ],
)
def test_profiling_tier(spark, census, hours, tier):
    frame = spark.createDataFrame([(census, hours)], "MDScensus int, Hrs_CNA double")
    assert values(frame.select(staffing.profiling_tier().alias("t")), "t") == [(tier,)]


def test_ratios_and_guards(silver_of):
    day = date(2024, 4, 1)
    frame = daily_metrics(silver_of(
        {"WorkDate": day},
        {"WorkDate": day, "MDScensus": 0},
        {"WorkDate": day, "Hrs_RN": 0.0},
        {"WorkDate": day, "Hrs_RN": None},
        {"WorkDate": day, "certified_beds": None},
        {"WorkDate": day, "certified_beds": 0.0},
        {"WorkDate": day, "MDScensus": 130},
    ))
    rows = frame.select(
        "CNA_hrs_per_patient", "RN_hrs_per_patient", "total_hrs_per_patient",
        "contracted_rn_ratio", "bed_occupancy_rate",
    ).collect()
    assert tuple(rows[0]) == (2.5, 0.6, 3.9, 0.1667, 0.8333)
    assert rows[1][:3] == (None, None, None)
    assert rows[2].contracted_rn_ratio == 0.0
    assert (rows[3].total_hrs_per_patient, rows[3].contracted_rn_ratio) == (None, 0.0)
    assert rows[4].bed_occupancy_rate is None and rows[5].bed_occupancy_rate is None
    assert rows[6].bed_occupancy_rate == 1.0833


def test_compliance_is_three_valued_and_uses_rounded_ratios(silver_of):
    day = date(2024, 4, 1)
    frame = daily_metrics(silver_of(
        {"WorkDate": day},
        # 2.44996 is below the minimum in Silver, and 2.45 once rounded
        {"WorkDate": day, "MDScensus": 100_000, "Hrs_CNA": 244_996.0, "Hrs_RN": 60_000.0, "Hrs_LPN": 80_000.0},
        {"WorkDate": day, "Hrs_CNA": 100.0},
        {"WorkDate": day, "Hrs_LPN": None},
        {"WorkDate": day, "Hrs_LPN": None, "Hrs_CNA": 100.0},
    ))
    assert [r[0] for r in values(frame, "meets_cms_minimums")] == [True, True, False, None, False]


def test_weekday_numbers(silver_of):
    frame = daily_metrics(silver_of(
        *[{"WorkDate": date(2024, 4, d)} for d in (5, 6, 7, 8)]  # Friday..Monday
    ))
    assert values(frame, "day_of_week", "is_weekend") == [(6, False), (7, True), (1, True), (2, False)]


def test_dates(spark):
    frame = spark.createDataFrame(
        [("20240430",), ("2024-04-01",), ("",), (None,), ("20240231",)], "t string"
    ).select(calendar.parse_work_date(F.col("t")).alias("d"))
    assert [r[0] for r in values(frame, "d")] == [date(2024, 4, 30), None, None, None, None]
    labels = spark.createDataFrame([(date(2024, 3, 31),), (date(2024, 4, 1),), (None,)], "d date").select(
        calendar.quarter_label(F.col("d")).alias("q"), calendar.week_start(F.col("d")).alias("w")
    )
    assert values(labels, "q", "w") == [
        ("2024Q1", date(2024, 3, 25)), ("2024Q2", date(2024, 4, 1)), (None, None),
    ]


@pytest.mark.parametrize(
    ("name", "quarter"),
    [
        ("PBJ_Daily_Nurse_Staffing_Q2_2024.csv", "2024Q2"),
        ("NH_ProviderInfo_Oct2024.csv", None),
        ("PBJ_Daily_Nurse_Staffing_2024Q2.csv", None),
        ("x_Q12_2024.csv", None),
        ("", None),
        (None, None),
    ],
)
def test_quarter_from_name(spark, name, quarter):
    frame = spark.createDataFrame([(name,)], "n string")
    assert values(frame.select(calendar.quarter_from_name(F.col("n")).alias("q")), "q") == [(quarter,)]


def test_shift_moves_only_the_listed_days(spark):
    days = [date(2024, 4, 1), date(2024, 4, 30), date(2024, 5, 10), date(2024, 5, 11),
            date(2024, 6, 10), date(2024, 6, 11), date(2024, 3, 31), date(2023, 4, 2)]
    frame = spark.createDataFrame([(d,) for d in days], "d date").select(
        calendar.shift_one_quarter(F.col("d"), year=2024).alias("listed"),
        calendar.shift_one_quarter(F.col("d"), every_day=True).alias("all"),
    )
    rows = frame.collect()
    assert [r.listed for r in rows] == [
        date(2024, 7, 1), date(2024, 7, 30), date(2024, 8, 10), date(2024, 5, 11),
        date(2024, 9, 10), date(2024, 6, 11), date(2024, 3, 31), date(2023, 4, 2),
    ]
    assert rows[3]["all"] == date(2024, 8, 11) and rows[6]["all"] == date(2024, 6, 30)


def test_exact_numbers_do_not_depend_on_order(spark):
    numbers = [(0.1,), (0.2,), (0.3,), (1e9,), (-0.05,), (None,)]
    for shuffled in (numbers, numbers[::-1], numbers[2:] + numbers[:2]):
        row = spark.createDataFrame(shuffled, "x double").agg(
            numeric.exact_sum("x", 1).alias("s"), numeric.exact_mean("x", 4).alias("m"),
            numeric.full_mean("x").alias("f"),
        ).first()
        assert tuple(row) == (1000000000.6, 200000000.11, 1000000000.55 / 5)


def test_rounding_modes_and_empty_groups(spark):
    frame = spark.createDataFrame([(0.12,), (0.13,)], "x double")
    row = frame.agg(
        numeric.exact_mean("x", 2).alias("up"), numeric.exact_mean("x", 2, half_even=True).alias("even")
    ).first()
    assert tuple(row) == (0.13, 0.12)
    empty = frame.filter("x > 1").agg(
        numeric.exact_mean("x", 2).alias("a"), numeric.full_mean("x").alias("b"),
        numeric.exact_sum("x", 1).alias("c"), numeric.percent(F.lit(0), numeric.row_count()).alias("d"),
        numeric.quotient_mean(F.col("x")).alias("e"),
    ).first()
    assert tuple(empty) == (None,) * 5


def test_sums_and_means_keep_every_value(spark):
    def of(values, kind="double"):
        frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
        return frame.agg(
            numeric.exact_sum("x", 1).alias("s"), numeric.exact_mean("x", 4).alias("m"),
            numeric.full_mean("x").alias("f"), numeric.quotient_mean(F.col("x")).alias("q"),
        ).first()

    large = of([1e15, 100.0])
    assert (large.s, large.m, large.f, large.q) == (1e15 + 100, 500000000000050.0, 500000000000050.0, 500000000000050.0)
    assert of([1e15]).m == 1e15
    fine = of([0.00004, 0.00004])
    assert (fine.f, fine.q) == (0.00004, 0.00004) and fine.m == 0.0
    assert of([0.00004, 1.0]).f == pytest.approx(0.50002)
    endless = of([float("inf"), 1.0])
    assert endless.s == endless.m == endless.f == endless.q == float("inf")
    assert tuple(of([250_000, 1], "int")) == (250001.0, 125000.5, 125000.5, 125000.5)
    assert of([1e9, 2e9]).q == 1.5e9
    assert tuple(of([9e11] * 20_000)) == (1.8e16, 9e11, 9e11, 9e11)
    assert tuple(of([float("nan"), None])) == (None, None, None, None)
    assert of([float("nan"), 2.0]).m == 2.0


def test_column_counts_of_the_layers():
    """Pinned by hand, since queries and SQL twins share the lists."""
    assert (len(SILVER_COLUMNS), len(set(SILVER_COLUMNS))) == (48, 48)
    assert len(DAILY_METRIC_COLUMNS) == 19 and len(FACILITY_GROUP) == 11
    assert len(STAFFING_COLUMNS) == 33 and len(HOUR_COLUMNS) == 24 and len(PROVIDER_FIELDS) == 9
