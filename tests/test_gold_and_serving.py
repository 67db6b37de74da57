from datetime import date, timedelta

import pytest

from rosterlake.config import DAILY_METRIC_COLUMNS, DRILL_DOWN_LABELS, Settings
from rosterlake.plans import serving
from rosterlake.plans.gold import facility_summary, staffing_metrics

MONDAY = date(2024, 4, 1)


def days(n, passing, **other):
    """``n`` days of which the first ``passing`` meet the minimums."""
    return [
        {"WorkDate": MONDAY + timedelta(days=i), "Hrs_CNA": 250.0 if i < passing else 100.0, **other}
        for i in range(n)
    ]


@pytest.mark.parametrize(
    ("n", "passing", "pct", "chronic"),
    [(4, 2, 50.0, False), (90, 45, 50.0, False), (2500, 1249, 50.0, False), (2000, 999, 50.0, False),
     (90, 44, 48.9, True), (10, 0, 0.0, True)],
)
def test_chronic_is_judged_on_the_rounded_share(silver_of, n, passing, pct, chronic):
    row = facility_summary(silver_of(*days(n, passing))).first()
    assert (row.pct_days_meeting_cms, row.chronically_understaffed) == (pct, chronic)
    assert (row.days_meeting_cms_minimum, row.total_days_in_quarter) == (passing, n)


def test_undecided_days_count_in_the_total_only(silver_of):
    rows = days(2, 2) + [{"WorkDate": MONDAY + timedelta(days=9), "Hrs_LPN": None}] * 2
    row = facility_summary(silver_of(*rows)).first()
    assert (row.days_meeting_cms_minimum, row.total_days_in_quarter, row.pct_days_meeting_cms) == (2, 4, 50.0)
    row = facility_summary(silver_of(*rows[2:])).first()
    assert (row.days_meeting_cms_minimum, row.pct_days_meeting_cms, row.chronically_understaffed) == (None,) * 3


def test_weekend_gap(silver_of):
    rows = [{"WorkDate": date(2024, 4, 6), "Hrs_CNA": 200.0}, {"WorkDate": date(2024, 4, 8)}]
    row = facility_summary(silver_of(*rows)).first()
    assert (row.avg_weekend_hrs_per_patient, row.avg_weekday_hrs_per_patient, row.weekend_staffing_gap) == (3.4, 3.9, -0.5)
    assert facility_summary(silver_of(rows[1])).first().weekend_staffing_gap is None


def test_null_attributes_form_one_group_and_renames_split(silver_of):
    rows = days(3, 3, certified_beds=None) + days(2, 2, PROVNAME="New name", certified_beds=None)
    out = facility_summary(silver_of(*rows)).collect()
    assert sorted(r.total_days_in_quarter for r in out) == [2, 3]
    assert all(r.avg_bed_occupancy_rate is None for r in out)


def test_daily_table_columns_and_settings(silver_of):
    silver = silver_of(*days(1, 1))
    assert staffing_metrics(silver).columns == list(DAILY_METRIC_COLUMNS)
    assert staffing_metrics(silver, Settings(cna_minimum=3.0)).first().meets_cms_minimums is False


@pytest.fixture(scope="module")
def facilities(silver_of):
    return facility_summary(silver_of(
        *days(10, 10, PROVNUM="a", STATE="AL"),
        *days(10, 1, PROVNUM="b", STATE="AL", Hrs_RN_ctr=30.0),
        *days(10, 0, PROVNUM="c", STATE="GA", ownership_type="Government", MDScensus=130),
        *days(10, 10, PROVNUM="d", STATE="TX", ownership_type=None),
    )).cache()


def test_filters(facilities):
    pick = lambda **k: sorted(r.PROVNUM for r in serving.facility_filter(facilities, **k).collect())
    assert pick() == ["a", "b", "c"]  # no ownership, not selectable
    assert pick(states=["AL"]) == ["a", "b"]
    assert pick(states=["AL"], understaffed_only=True) == ["b"]
    assert pick(ownership=["Government"]) == ["c"]
    assert pick(states=["GA", "AL"], ownership=["For profit"]) == ["a", "b"]
    assert [tuple(r) for r in serving.filter_options(facilities).collect()] == [
        ("STATE", "AL"), ("STATE", "GA"), ("STATE", "TX"), ("ownership_type", "For profit"), ("ownership_type", "Government"),
    ]
    assert tuple(serving.filter_summary(facilities).first()) == (4, 3, "2024Q2")


def test_kpis(facilities):
    row = serving.kpi_cards(serving.facility_filter(facilities)).first()
    assert (row.facilities, row.chronic) == (3, 2)
    assert row.pct_meeting == pytest.approx(100 / 3) and row.pct_chronic == pytest.approx(200 / 3)
    assert row.cna_vs_minimum == pytest.approx(row.avg_cna - 2.45)
    empty = serving.kpi_cards(facilities.limit(0)).first()
    assert empty.facilities == 0 and empty.avg_cna is None and empty.pct_meeting is None


def test_rates(facilities):
    assert tuple(serving.facility_compliance_rate(facilities).first()) == (4, 2, 50.0)
    assert tuple(serving.facility_compliance_rate(facilities.limit(0)).first()) == (0, 0, None)


def test_charts_and_rankings(facilities):
    assert {r.STATE for r in serving.occupancy_scatter(facilities).collect()} == {"AL", "TX"}
    contract = serving.contract_by_state(facilities).collect()
    assert (contract[0].STATE, contract[0].contracted_pct, contract[0].facility_count) == ("AL", 33.3, 2)
    assert [r.STATE for r in serving.cna_by_state(facilities, 2).collect()] == ["GA", "AL"]
    assert [r.ownership_type for r in serving.cna_by_ownership(facilities).collect()] == ["Government", "For profit"]
    assert [tuple(r) for r in serving.chronic_by_state(facilities).collect()] == [("AL", 1), ("GA", 1)]
    worst = serving.worst_facilities(facilities).collect()
    assert [(r.STATE, r.pct_days_meeting_cms) for r in worst] == [("GA", 0.0), ("AL", 10.0)]


def test_drill_down(facilities):
    out = serving.drill_down(facilities)
    assert out.columns == list(DRILL_DOWN_LABELS.values())
    assert [r.CCN for r in out.collect()] == ["c", "b", "a", "d"]
    assert out.collect()[0]["Occupancy"] == 1.08


def test_weekly_trend(silver_of):
    daily = staffing_metrics(silver_of(
        *days(8, 7), *days(8, 0, STATE="GA"), {"WorkDate": None},
    ))
    trend = serving.weekly_trend(daily, ["AL"])
    assert [(r.week, r.avg_cna) for r in trend.collect()] == [(MONDAY, 2.5), (MONDAY + timedelta(days=7), 1.0)]
    assert [(r.week, r.avg_cna) for r in serving.weekly_trend(daily).collect()][0] == (MONDAY, 1.75)
    long = serving.weekly_trend_long(trend).collect()
    assert {r.staff_type for r in long} == {"CNA", "RN", "Total Nurses"} and len(long) == 6
