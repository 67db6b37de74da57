"""Reports against numpy and pandas on small and skewed inputs."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from rosterlake.config import HOUR_COLUMNS
from rosterlake.operators import generate, profile
from rosterlake.operators.quantiles import exact_quantiles


def by_column(frame):
    return {row.column_name: row for row in frame.collect()}


def random_values(kind, size=3000):
    rng = np.random.default_rng(7)
    if kind == "spread":
        return np.round(rng.gamma(2.0, 40.0, size), 2)
    if kind == "hot":  # a third of the rows share one value
        return np.where(rng.random(size) < 0.34, 12.5, np.round(rng.gamma(2.0, 40.0, size), 2))
    if kind == "constant":
        return np.full(size, 3.25)
    if kind == "outlier":
        return np.append(np.round(rng.random(size), 3), [1e9, -1e9])
    return np.array([4.0])


@pytest.mark.parametrize("kind", ["spread", "hot", "constant", "outlier", "single"])
def test_exact_quantiles_match_numpy(spark, kind):
    values = random_values(kind)
    frame = spark.createDataFrame(
        [(float(v), None) for v in values] + [(None, 1.0)], "a double, b double"
    ).repartition(5)
    probabilities = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    rows = by_column(exact_quantiles(frame, ("a", "b"), probabilities))
    for name, p in probabilities.items():
        assert rows["a"][name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)
        assert rows["b"][name] == 1.0


def test_describe_stats(spark):
    values = random_values("spread")
    frame = spark.createDataFrame([(float(v), None) for v in values], "x double, y double")
    rows = by_column(profile.describe_stats(frame, ("x", "y")))
    expected = pd.Series(values).describe()
    row = rows["x"]
    assert row["count"] == len(values)
    for name, label in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                        ("p75", "75%"), ("max", "max")):
        assert row[name] == pytest.approx(expected[label], abs=0.0051)
    assert tuple(rows["y"])[1:] == (0,) + (None,) * 7


@pytest.mark.parametrize("values", [
    [0, 1, 5, 49, 50, 51, 299, 300, 301, 900, 150, 150],
    [40, 40, 40],
    [10, 11],
    list(range(0, 400, 3)),
])
def test_histogram_matches_numpy(staffing_of, values):
    rows = profile.census_histogram(staffing_of(*[{"MDScensus": v} for v in [*values, None]])).orderBy("bin").collect()
    counts, edges = np.histogram(np.minimum(values, 300), bins=50)
    assert [r.days for r in rows] == counts.tolist()
    assert [r.bin_from for r in rows] == pytest.approx(edges[:-1].tolist())
    assert [r.bin_to for r in rows] == pytest.approx(edges[1:].tolist())


def test_zero_report(staffing_of):
    rows = by_column(profile.zero_report(staffing_of(
        {"Hrs_RN": 2.0, "Hrs_CNA": None}, {"Hrs_RN": 3.01, "Hrs_CNA": None}, {"Hrs_RN": 0.0, "Hrs_CNA": 0.0},
    )))
    assert tuple(rows["Hrs_RN"])[1:] == (1, 33.3, 2.5)  # 2.505 rounds to the even neighbour
    assert tuple(rows["Hrs_LPN"])[1:] == (3, 100.0, 0.0)
    assert tuple(rows["Hrs_CNA"])[1:] == (1, 33.3, None)
    assert set(rows) == set(HOUR_COLUMNS)


def test_missing_report_lists_only_columns_with_nulls(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 1.0, "y")], "a int, b double, c string")
    assert [tuple(r) for r in profile.missing_report(frame).collect()] == [("b", 2, 66.67), ("c", 1, 33.33)]
    assert profile.missing_report(frame.limit(0)).count() == 0


def test_duplicate_keys_ignore_null_keys(staffing_of):
    day = date(2024, 4, 1)
    frame = staffing_of({"WorkDate": day}, {"WorkDate": day}, {"WorkDate": None}, {"WorkDate": None})
    assert [tuple(r) for r in profile.duplicate_keys(frame).collect()] == [("015009", day, 2)]


def test_identity(staffing_of):
    start = date(2024, 4, 1)
    frame = staffing_of(*[
        {"PROVNUM": p, "STATE": s, "WorkDate": start + timedelta(days=i)}
        for i, (p, s) in enumerate([("a", "AL"), ("a", "AL"), ("b", "GA"), (None, None)])
    ])
    assert tuple(profile.identity_profile(frame).first()) == (2, 2, 1, start, start + timedelta(days=3))
    assert [r.STATE for r in profile.value_list(frame, "STATE").collect()] == ["AL", "GA"]


def test_offenders_means_and_rates(staffing_of):
    day = date(2024, 4, 1)
    frame = staffing_of(
        {"PROVNUM": "a", "WorkDate": day, "MDScensus": 50, "Hrs_CNA": 50.0, "Hrs_RN": 25.0},
        {"PROVNUM": "a", "WorkDate": day, "MDScensus": 30, "Hrs_CNA": 10.0, "Hrs_RN": 10.0},
        {"PROVNUM": "b", "WorkDate": day, "MDScensus": 50, "Hrs_CNA": 200.0},
        {"PROVNUM": "c", "WorkDate": day, "MDScensus": 5, "Hrs_CNA": 1.0},
        {"PROVNUM": None, "WorkDate": day, "MDScensus": 50, "Hrs_CNA": 1.0},
    )
    assert [tuple(r) for r in profile.chronic_offenders(frame).collect()] == [
        ("a", "Home", "AL", 2, pytest.approx(2 / 3), 40.0)
    ]
    means = {r.PROVNUM: r for r in profile.facility_means(frame).collect()}
    assert set(means) == {"a", "b"}
    assert means["a"].avg_RN_ratio == pytest.approx((0.5 + 1 / 3) / 2) and means["a"].days_in_quarter == 2
    assert tuple(profile.tier_pass_rate(frame).first()) == (5, 1, 20.0)
    assert {r.staffing_tier: r.days for r in profile.tier_profile(frame).collect()} == {
        "below_cms_minimum": 1, "critical_understaffed": 2, "exclude_low_census": 1, "meets_cms_minimum": 1,
    }


def test_presence_schema_and_samples(staffing_of):
    frame = staffing_of({"WorkDate": date(2024, 4, 2)}, {"WorkDate": date(2024, 4, 1)})
    rows = by_column(profile.column_presence(frame, ("STATE", "nothing")))
    assert (rows["STATE"].status, rows["STATE"].filled_rows) == ("OK", 2)
    assert (rows["nothing"].status, rows["nothing"].filled_rows) == ("MISSING", None)
    report = profile.schema_report(frame).collect()
    assert (report[8].column_name, report[8].data_type, report[8].filled_rows) == ("MDScensus", "int", 2)
    assert profile.first_rows(frame, 1).first().WorkDate == date(2024, 4, 1)
    assert profile.first_rows(frame, 5, None).count() == 2


def test_shift_quarter_relabels(staffing_of):
    out = generate.shift_quarter(staffing_of({"WorkDate": date(2024, 4, 5)}), "2024Q3").first()
    assert (out.WorkDate, out.CY_Qtr) == (date(2024, 7, 5), "2024Q3")


def test_nan_is_missing_in_profiles(spark, staffing_of):
    frame = staffing_of({"Hrs_RN": float("nan")}, {"Hrs_RN": 2.0}, {"Hrs_RN": 3.0})
    stats = by_column(profile.describe_stats(frame))["Hrs_RN"]
    assert (stats["count"], stats["mean"], stats["std"], stats["p75"], stats["max"]) == (2, 2.5, 0.71, 2.75, 3.0)
    missing = {r.column_name: r.missing_count for r in profile.missing_report(frame).collect()}
    assert missing["Hrs_RN"] == 1
    assert by_column(profile.zero_report(frame))["Hrs_RN"]["mean_nonzero"] == 2.5


def test_large_census_does_not_overflow(spark, staffing_of):
    frame = staffing_of({"MDScensus": 250_000, "PROVNUM": "a"}, {"MDScensus": 1, "PROVNUM": "a"})
    assert by_column(profile.describe_stats(frame))["MDScensus"]["mean"] == 125000.5
    assert profile.facility_means(frame).first() is not None
