"""The registered queries as DuckDB SQL over the base tables.

Written from the definitions, not from the Spark plans. Rounding is spelled out so that
both engines give the same bits:

* ``up(x, n)``: half up on the decimal text of a double;
* ``mean_up`` / ``mean_even``: integer rounding of an exact sum of values with up to eight decimals;
* ``pct_up`` / ``pct_even``: integer rounding of a ratio of counts.
"""

from __future__ import annotations

from rosterlake.config import (
    CORRELATED_MEASURES,
    CORRELATED_QUALITIES,
    DAILY_METRIC_COLUMNS,
    DRILL_DOWN_LABELS,
    DRILL_DOWN_TWO_DECIMALS,
    EXPECTED_AFTER_JOIN,
    FACILITY_GROUP,
    HOUR_COLUMNS,
    NURSE_TYPE_LABELS,
    PROVIDER_FIELDS,
    ROLES,
    STAFFING_COLUMNS,
    STATS_COLUMNS,
)
from parity.registry import SAMPLE_ROWS, SCAN_QUARTER, SHIFTED_LABEL, SOME_OWNERS, SOME_STATES


def up(x: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


_SCALE = 8  # decimals of any hour or ratio in the fixture


def even(x: str, n: int) -> str:
    """Half even for values with at most eight decimals."""
    k = f"CAST(round(CAST(({x}) AS DOUBLE) * {10 ** _SCALE}) AS HUGEINT)"
    return _half_even(f"abs({k})", str(10 ** (_SCALE - n)), n, f"sign({k})")


def _half_even(num: str, den: str, digits: int, sign: str = "1") -> str:
    """num/den rounded half even to an integer, then scaled down by 10^digits."""
    q, r = f"(({num}) // ({den}))", f"(({num}) % ({den}))"
    step = f"CASE WHEN 2*{r} > ({den}) OR (2*{r} = ({den}) AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CAST(({sign}) * ({q} + {step}) AS DOUBLE) / {10 ** digits})"


def _units(x: str) -> str:
    return f"CAST(sum(CAST(({x}) AS DECIMAL(28,{_SCALE})))*{10 ** _SCALE} AS HUGEINT)"


def mean_up(x: str, d: int) -> str:
    s, n, m = _units(x), f"count({x})", 10 ** (_SCALE - d)
    return f"(CAST((2*{s} + {n}*{m}) // (2*{n}*{m}) AS DOUBLE) / {10 ** d})"


def mean_even(x: str, d: int) -> str:
    return (
        f"CASE WHEN count({x}) > 0 THEN "
        f"{_half_even(_units(x), f'nullif(count({x}),0)*{10 ** (_SCALE - d)}', d)} END"
    )


def sum_up(x: str, d: int) -> str:
    s, m = _units(x), 10 ** (_SCALE - d)
    return f"(CAST((2*{s} + {m}) // (2*{m}) AS DOUBLE) / {10 ** d})"


def mean(x: str, quotients: bool = False) -> str:
    if quotients:
        dec = f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), 18) AS DECIMAL(38,18))"
    else:
        dec = f"CAST(({x}) AS DECIMAL(28,{_SCALE}))"
    return f"(CAST(CAST(sum({dec}) AS VARCHAR) AS DOUBLE) / count({x}))"


def pct_up(z: str, n: str, d: int) -> str:
    m = 10 ** d
    return f"(CAST((2*{100 * m}*CAST({z} AS HUGEINT) + ({n})) // (2*({n})) AS DOUBLE) / {m})"


def pct_even(z: str, n: str, d: int) -> str:
    return _half_even(f"{100 * 10 ** d}*CAST({z} AS HUGEINT)", n, d)


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _quoted(names) -> str:
    return ", ".join(f"'{name}'" for name in names)


# --- common table expressions -------------------------------------------------------

def _days(where: str = "") -> str:
    return f"""
SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS d, count(*) AS lines, sum(q) AS qty,
  sum(CASE WHEN l_linestatus='F' THEN q ELSE 0 END) AS qty_f,
  sum(q*disc) AS disc, sum(CASE WHEN l_returnflag='R' THEN q*disc ELSE 0 END) AS disc_r,
  sum(CASE WHEN l_linestatus='F' THEN q*disc ELSE 0 END) AS disc_f,
  sum(q*tax) AS tax, sum(CASE WHEN l_returnflag='R' THEN q*tax ELSE 0 END) AS tax_r,
  sum(l_linenumber) AS lineno, sum(CASE WHEN l_returnflag='A' THEN l_linenumber ELSE 0 END) AS lineno_a,
  sum(l_partkey % 8) AS part, sum(CASE WHEN l_linestatus='F' THEN l_partkey % 8 ELSE 0 END) AS part_f,
  sum(CASE WHEN disc=0 THEN tax ELSE 0 END) AS untaxed,
  sum(l_orderkey % 16) AS ord, sum(CASE WHEN l_returnflag='A' THEN l_orderkey % 16 ELSE 0 END) AS ord_a
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(round(l_discount*100) AS BIGINT) AS disc,
        CAST(round(l_tax*100) AS BIGINT) AS tax FROM lineitem {where})
GROUP BY 1, 2"""


_HOUR_SOURCES = {
    "RNDON": ("lines*8", "0", 1),
    "RNadmin": ("lineno", "lineno_a", 4),
    "RN": ("(8*tax+lineno)", "(8*tax_r+lineno_a)", 64),
    "LPNadmin": ("part", "part_f", 2),
    "LPN": ("(10*qty-disc)", "(10*qty_f-disc_f)", 8),
    "CNA": ("disc", "disc_r", 2),
    "NAtrn": ("untaxed", "0", 4),
    "MedAide": (
        "CASE WHEN k % 7 <> 2 THEN ord END", "CASE WHEN k % 7 <> 2 THEN ord_a END", 4),
}


def _pbj(days: str) -> str:
    hours = []
    for role in ROLES:
        total, contract, div = _HOUR_SOURCES[role]
        hours.append(f"CAST({total} AS DOUBLE)/{div} AS Hrs_{role}")
        hours.append(f"CAST(({total}) - ({contract}) AS DOUBLE)/{div} AS Hrs_{role}_emp")
        hours.append(f"CAST({contract} AS DOUBLE)/{div} AS Hrs_{role}_ctr")
    return f"""
SELECT lpad(CAST(k AS VARCHAR),6,'0') AS PROVNUM, s_name AS PROVNAME, r_name AS CITY, n_name AS STATE,
  'Cañon ' || n_name AS COUNTY_NAME, lpad(CAST(n_nationkey AS VARCHAR),3,'0') AS COUNTY_FIPS,
  CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS CY_Qtr, d AS WorkDate,
  CAST(qty AS INTEGER) AS MDScensus, {', '.join(hours)}
FROM {days} JOIN supplier ON k = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""


_PROV = """
SELECT lpad(CAST(s_suppkey AS VARCHAR),6,'0') AS CCN,
  CASE s_nationkey % 3 WHEN 0 THEN 'For profit - Corporation' WHEN 1 THEN 'Government - County'
    ELSE 'Non profit - Other' END AS ownership_type,
  CASE s_suppkey % 2 WHEN 0 THEN 'Medicare and Medicaid' ELSE 'Medicare' END AS provider_type,
  CASE WHEN s_suppkey % 13 = 5 THEN NULL ELSE CAST(40 + (s_suppkey*7) % 60 AS DOUBLE) END AS certified_beds,
  CAST(1 + s_suppkey % 5 AS DOUBLE) AS overall_rating, CAST(1 + (s_suppkey*3) % 5 AS DOUBLE) AS staffing_rating,
  CAST((s_suppkey*11) % 100 AS DOUBLE) AS nursing_turnover,
  CAST(s_suppkey % 9 AS DOUBLE)/8 AS reported_rn_hrs, CAST(s_suppkey % 23 AS DOUBLE)/8 AS reported_cna_hrs
FROM supplier WHERE s_acctbal >= 1000"""

_READ_TEXT = """
SELECT * REPLACE (CASE WHEN day(WorkDate)=31 THEN NULL ELSE WorkDate END AS WorkDate,
  CASE WHEN day(WorkDate) % 10 = 7 THEN NULL ELSE MDScensus END AS MDScensus) FROM pbj"""


def _joined(staffing: str) -> str:
    return f"SELECT * FROM {staffing} LEFT JOIN prov ON PROVNUM = CCN WHERE MDScensus >= 10"


def _silver(joined: str, quarter: str) -> str:
    return f"""
SELECT *, CASE WHEN cna IS NULL THEN 'exclude_zero_census' WHEN cna = 0 THEN 'critical_no_staff'
    WHEN cna < 1 THEN 'critical_understaffed' WHEN cna < CAST(2.45 AS DOUBLE) THEN 'below_cms_minimum'
    ELSE 'meets_cms_minimum' END AS staffing_tier
FROM (SELECT *, Hrs_CNA/MDScensus AS cna, Hrs_RN/MDScensus AS rn, Hrs_LPN/MDScensus AS lpn,
  (Hrs_RN+Hrs_LPN+Hrs_CNA)/MDScensus AS total, MDScensus/certified_beds AS occ,
  CASE WHEN Hrs_RN > 0 THEN Hrs_RN_ctr/Hrs_RN ELSE 0.0::DOUBLE END AS ctr, {quarter} AS quarter
  FROM {joined} WHERE CCN IS NOT NULL)"""


def _daily(silver: str) -> str:
    rounded = ", ".join(
        f"{up(short, 4)} AS {name}"
        for short, name in (
            ("cna", "CNA_hrs_per_patient"), ("rn", "RN_hrs_per_patient"),
            ("lpn", "LPN_hrs_per_patient"), ("total", "total_hrs_per_patient"),
            ("occ", "bed_occupancy_rate"), ("ctr", "contracted_rn_ratio"),
        )
    )
    return f"""
SELECT *, CNA_hrs_per_patient >= CAST(2.45 AS DOUBLE) AND RN_hrs_per_patient >= CAST(0.55 AS DOUBLE)
    AND total_hrs_per_patient >= CAST(3.48 AS DOUBLE) AS meets_cms_minimums,
  CAST(dayofweek(WorkDate) + 1 AS INTEGER) AS day_of_week, dayofweek(WorkDate) IN (0, 6) AS is_weekend
FROM (SELECT *, {rounded} FROM {silver})"""


def _facility(daily: str) -> str:
    total = "total_hrs_per_patient"
    weekend, weekday = f"CASE WHEN is_weekend THEN {total} END", f"CASE WHEN NOT is_weekend THEN {total} END"
    guard = lambda x: f"CASE WHEN count({x}) > 0 THEN {mean_up(x, 4)} END"
    means = ", ".join(
        f"{guard(source)} AS {name}"
        for name, source in (
            ("avg_bed_occupancy_rate", "bed_occupancy_rate"),
            ("avg_CNA_hrs_per_patient", "CNA_hrs_per_patient"),
            ("avg_RN_hrs_per_patient", "RN_hrs_per_patient"),
            ("avg_LPN_hrs_per_patient", "LPN_hrs_per_patient"),
            ("avg_total_hrs_per_patient", "total_hrs_per_patient"),
            ("avg_contracted_rn_ratio", "contracted_rn_ratio"),
        )
    )
    sums = ", ".join(
        f"{sum_up(source, 1)} AS {name}"
        for name, source in (
            ("total_RN_hours", "Hrs_RN"), ("total_LPN_hours", "Hrs_LPN"),
            ("total_CNA_hours", "Hrs_CNA"), ("total_contracted_RN_hours", "Hrs_RN_ctr"),
            ("total_employed_RN_hours", "Hrs_RN_emp"),
        )
    )
    return f"""
SELECT *, pct_days_meeting_cms < 50 AS chronically_understaffed FROM (
SELECT *, {up("CAST(days_meeting_cms_minimum AS DOUBLE) / total_days_in_quarter * 100", 1)} AS pct_days_meeting_cms,
  {up("avg_weekend_hrs_per_patient - avg_weekday_hrs_per_patient", 4)} AS weekend_staffing_gap FROM (
SELECT {', '.join(FACILITY_GROUP)}, {mean_up("MDScensus", 1)} AS avg_daily_census, {means}, {sums},
  CAST(sum(CAST(meets_cms_minimums AS INTEGER)) AS BIGINT) AS days_meeting_cms_minimum,
  count(WorkDate) AS total_days_in_quarter,
  {guard(weekend)} AS avg_weekend_hrs_per_patient, {guard(weekday)} AS avg_weekday_hrs_per_patient
FROM {daily} GROUP BY {', '.join(FACILITY_GROUP)}))"""


_LABEL = "CAST(year(WorkDate) AS VARCHAR) || 'Q' || CAST(quarter(WorkDate) AS VARCHAR)"
_MANIFEST = """
SELECT o_orderkey AS id, CASE o_orderkey % 5
    WHEN 1 THEN 'NH_ProviderInfo_Oct' || y
    WHEN 2 THEN 'NH_QualityMsr_Claims_Q' || q || '_' || y
    WHEN 3 THEN 'PBJ_Daily_Nurse_Staffing_' || y || 'Q' || q
    ELSE 'PBJ_Daily_Nurse_Staffing_Q' || q || '_' || y END
  || '-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.csv' AS name
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y,
        CAST(quarter(o_orderdate) AS VARCHAR) AS q FROM orders)"""
_FILES = r"""
SELECT *, CASE WHEN regexp_matches(name, 'Q\d_\d{4}')
  THEN regexp_extract(name, 'Q(\d)_(\d{4})', 2) || 'Q' || regexp_extract(name, 'Q(\d)_(\d{4})', 1) END AS quarter
FROM manifest"""
_LANDED = """
SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2000-01-01'"""
_FRESH = """
SELECT DISTINCT quarter FROM files WHERE contains(name, 'PBJ_Daily_Nurse_Staffing') AND quarter IS NOT NULL
  AND quarter NOT IN (SELECT quarter FROM landed)"""

# name -> (what it needs, text)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "days": ((), _days()),
    "pbj": (("days",), _pbj("days")),
    "prov": ((), _PROV),
    "joined": (("pbj", "prov"), _joined("pbj")),
    "listed": (("prov",), """
SELECT * FROM prov
UNION ALL SELECT * REPLACE (overall_rating + 1 AS overall_rating) FROM prov WHERE CAST(CCN AS INT) % 10 = 3
UNION ALL SELECT * REPLACE (CAST(NULL AS DOUBLE) AS certified_beds) FROM prov WHERE CAST(CCN AS INT) % 10 = 7
UNION ALL SELECT * FROM prov WHERE CAST(CCN AS INT) % 25 = 4"""),
    "unique_prov": (("listed",), "SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY CCN ORDER BY "
                    + " + ".join(f"CAST({n} IS NOT NULL AS INT)" for n, _ in list(PROVIDER_FIELDS.values())[1:]) + " DESC, "
                    + ", ".join(f"{n} DESC NULLS LAST" for n, _ in list(PROVIDER_FIELDS.values())[1:]) + ") = 1"),
    "silver": (("joined",), _silver("joined", _LABEL)),
    "daily": (("silver",), _daily("silver")),
    "facility": (("daily",), _facility("daily")),
    "typed": (("pbj",), _READ_TEXT),
    "typed_joined": (("typed", "prov"), _joined("typed")),
    "typed_silver": (("typed_joined",), _silver("typed_joined", "CY_Qtr")),
    "manifest": ((), _MANIFEST),
    "files": (("manifest",), _FILES),
    "landed": ((), _LANDED),
    "fresh": (("files", "landed"), _FRESH),
    "shown": (("facility",), "SELECT * FROM facility WHERE STATE IS NOT NULL AND ownership_type IS NOT NULL"),
    "picked": (
        ("facility",),
        f"SELECT * FROM facility WHERE STATE IN ({_quoted(SOME_STATES)}) "
        f"AND ownership_type IN ({_quoted(SOME_OWNERS)})",
    ),
    "drill": (
        ("shown",),
        "SELECT " + ", ".join(
            f"{even(name, 2) if name in DRILL_DOWN_TWO_DECIMALS else name} AS \"{label}\""
            for name, label in DRILL_DOWN_LABELS.items()
        ) + " FROM shown",
    ),
}
for _tag in ("F", "O"):
    _low = _tag.lower()
    _CTES |= {
        f"days_{_low}": ((), _days(f"WHERE l_linestatus = '{_tag}'")),
        f"pbj_{_low}": ((f"days_{_low}",), _pbj(f"days_{_low}")),
        f"joined_{_low}": ((f"pbj_{_low}", "prov"), _joined(f"pbj_{_low}")),
        f"silver_{_low}": ((f"joined_{_low}",), _silver(f"joined_{_low}", _LABEL)),
        f"daily_{_low}": ((f"silver_{_low}",), _daily(f"silver_{_low}")),
        f"facility_{_low}": ((f"daily_{_low}",), _facility(f"daily_{_low}")),
    }


def sql(body: str, *needs: str) -> str:
    """``body`` behind the common table expressions it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _CTES[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in order)
    return f"WITH {ctes}\n{body}" if ctes else body


# --- queries ----------------------------------------------------------------------------

_PROVIDER_NAMES = [name for name, _ in PROVIDER_FIELDS.values()]
_JOINED_COLUMNS = ", ".join([*STAFFING_COLUMNS, *_PROVIDER_NAMES])
_SILVER_COLUMNS = (
    f"{_JOINED_COLUMNS}, cna AS CNA_hrs_per_patient, rn AS RN_hrs_per_patient, "
    "total AS total_hrs_per_patient, ctr AS contracted_rn_ratio, staffing_tier, quarter"
)
_DAILY_COLUMNS = ", ".join(DAILY_METRIC_COLUMNS)
_TIER_OF = """CASE WHEN MDScensus < 10 THEN 'exclude_low_census'
  WHEN MDScensus IS NULL OR MDScensus = 0 OR Hrs_CNA IS NULL THEN 'exclude_zero_census'
  WHEN Hrs_CNA = 0 THEN 'critical_no_staff' WHEN Hrs_CNA/MDScensus < 1 THEN 'critical_understaffed'
  WHEN Hrs_CNA/MDScensus < CAST(2.45 AS DOUBLE) THEN 'below_cms_minimum' ELSE 'meets_cms_minimum' END"""
_TYPES = {
    **{name: "string" for name in STAFFING_COLUMNS}, **{name: "double" for name in HOUR_COLUMNS},
    "WorkDate": "date", "MDScensus": "int",
}
_PASSING = "count(*) FILTER (tier = 'meets_cms_minimum')"
_RATIO = "Hrs_CNA/nullif(MDScensus,0)"


def _each(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


def _text_of(name: str) -> str:
    return f"CAST(CAST({name} AS DECIMAL(18,8)) AS VARCHAR) AS {name}"


def _describe(name: str) -> str:
    quart = ", ".join(
        f"{even(f'quantile_cont(CAST({name} AS DOUBLE), {p})', 2)} AS {alias}"
        for p, alias in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    )
    return f"""SELECT '{name}' AS column_name, count({name}) AS count, {mean_even(name, 2)} AS mean,
  {up(f"stddev_samp({name})", 2)} AS std, {even(f"min({name})", 2)} AS min, {quart},
  {even(f"max({name})", 2)} AS max FROM pbj"""


_FACILITY_MEANS = (
    f"SELECT PROVNUM, {mean('Hrs_CNA/MDScensus', True)} AS avg_CNA_ratio, "
    f"{mean('Hrs_RN/MDScensus', True)} AS avg_RN_ratio, "
    f"{mean('(Hrs_RN+Hrs_LPN+Hrs_CNA)/MDScensus', True)} AS avg_total_ratio, "
    f"{mean('MDScensus')} AS avg_census, count(WorkDate) AS days_in_quarter "
    "FROM pbj WHERE MDScensus >= 10 GROUP BY 1"
)
_MERGED_ANTI = "SELECT {cols} FROM {a} t WHERE NOT EXISTS (SELECT 1 FROM {b} s WHERE {on})"
_DAY_ON = "s.PROVNUM = t.PROVNUM AND s.WorkDate = t.WorkDate"
_FACILITY_ON = "s.PROVNUM = t.PROVNUM AND s.quarter = t.quarter"
_UPSERTED = sql(
    _MERGED_ANTI.format(cols="*", a="facility_f", b="facility_o", on=_FACILITY_ON)
    + " UNION ALL SELECT * FROM facility_o", "facility_f", "facility_o")
_INSERTED = sql(
    f"SELECT {_DAILY_COLUMNS} FROM daily_f UNION ALL "
    + _MERGED_ANTI.format(cols=_DAILY_COLUMNS, a="daily_o", b="daily_f", on=_DAY_ON),
    "daily_f", "daily_o")
_TREND = (
    "SELECT CAST(date_trunc('week', WorkDate) AS DATE) AS week, "
    f"{mean('CNA_hrs_per_patient')} AS avg_cna, {mean('RN_hrs_per_patient')} AS avg_rn, "
    f"{mean('total_hrs_per_patient')} AS avg_total FROM daily {{where}} GROUP BY 1"
)
_SHIFT = """SELECT PROVNUM, CAST({day} AS DATE) AS WorkDate, '""" + SHIFTED_LABEL + """' AS CY_Qtr, MDScensus FROM pbj"""

ORACLE: dict[str, str] = {
    "scan_staffing": sql(
        "SELECT PROVNUM, PROVNAME, CITY, STATE, COUNTY_NAME, COUNTY_FIPS, CY_Qtr, "
        "CASE WHEN day(WorkDate)=31 THEN 'n/a' ELSE strftime(WorkDate, '%Y%m%d') END AS WorkDate, "
        "CASE day(WorkDate) % 10 WHEN 7 THEN NULL WHEN 3 THEN CAST(MDScensus AS VARCHAR) || '.0' "
        "ELSE CAST(MDScensus AS VARCHAR) END AS MDScensus, "
        + ", ".join(_text_of(name) for name in HOUR_COLUMNS) + ", CY_Qtr AS quarter FROM pbj", "pbj"),
    "scan_provider": sql(
        "SELECT CCN, ownership_type, provider_type, "
        + ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in _PROVIDER_NAMES[3:]) + " FROM prov", "prov"),
    "silver_quarter_scan": sql(
        f"SELECT {_SILVER_COLUMNS} FROM silver WHERE quarter = '{SCAN_QUARTER}'", "silver"),
    "extract_quarter": sql("SELECT name, quarter FROM files", "files"),
    "new_quarters": sql("SELECT quarter FROM fresh", "fresh"),
    "assign_files": sql(
        "SELECT id, name, quarter FROM files JOIN fresh USING (quarter) "
        "UNION ALL SELECT id, name, fresh.quarter FROM files, fresh WHERE files.quarter IS NULL", "fresh"),
    "sample_n": sql(f"SELECT * FROM pbj ORDER BY PROVNUM, WorkDate LIMIT {SAMPLE_ROWS}", "pbj"),
    "schema_report": sql(_each([
        f"SELECT {i} AS position, '{n}' AS column_name, '{_TYPES[n]}' AS data_type, "
        f"count({n}) AS filled_rows FROM pbj" for i, n in enumerate(STAFFING_COLUMNS)]), "pbj"),
    "column_presence": sql(_each([
        f"SELECT '{header}' AS column_name, "
        + ("'MISSING' AS status, CAST(NULL AS BIGINT) AS filled_rows"
           if header == "Total nursing staff turnover" else
           f"'OK' AS status, (SELECT count({PROVIDER_FIELDS.get(header, (header, ''))[0]}) "
           "FROM pbj LEFT JOIN prov ON PROVNUM = CCN) AS filled_rows")
        for header in EXPECTED_AFTER_JOIN]), "pbj", "prov"),
    "joined_preview": sql(
        "SELECT " + ", ".join(
            (f'CAST({PROVIDER_FIELDS[h][0]} AS VARCHAR) AS "{h}"' if h in PROVIDER_FIELDS else h)
            for h in EXPECTED_AFTER_JOIN if h != "Total nursing staff turnover")
        + " FROM pbj LEFT JOIN prov ON PROVNUM = CCN ORDER BY PROVNUM, WorkDate LIMIT 3", "pbj", "prov"),
    "merge_insert_only": _INSERTED,
    "insert_table": _INSERTED,
    "merge_upsert": _UPSERTED,
    "upsert_table": _UPSERTED,
    "audit_unmatched": sql(f"SELECT {_JOINED_COLUMNS} FROM joined WHERE CCN IS NULL", "joined"),
    "validate_silver": sql(
        "SELECT quarter, staffing_tier, count(*) AS days FROM silver GROUP BY 1, 2", "silver"),
    "csv_export": sql(
        "SELECT " + ", ".join(f'CAST("{label}" AS VARCHAR) AS "{label}"'
                              for label in DRILL_DOWN_LABELS.values()) + " FROM drill", "drill"),
    "typed_staffing": sql("SELECT * FROM typed", "typed"),
    "provider_select": sql("SELECT * FROM prov", "prov"),
    "filter_low_census": sql("SELECT * FROM pbj WHERE MDScensus >= 10", "pbj"),
    "excluded_rows": sql(
        "SELECT count(*) AS raw_rows, count(*) FILTER (MDScensus >= 10) AS kept_rows, "
        "count(*) - count(*) FILTER (MDScensus >= 10) AS excluded_rows FROM pbj", "pbj"),
    "join_provider": sql(f"SELECT {_JOINED_COLUMNS} FROM joined", "joined"),
    "join_provider_salted": sql(f"SELECT {_JOINED_COLUMNS} FROM joined", "joined"),
    "matched_rows": sql(f"SELECT {_JOINED_COLUMNS} FROM joined WHERE CCN IS NOT NULL", "joined"),
    "join_coverage": sql(
        "SELECT count(*) AS facilities, count(CCN) AS matched, count(*) - count(CCN) AS unmatched, "
        f"{pct_up('count(CCN)', 'count(*)', 1)} AS match_pct "
        "FROM (SELECT DISTINCT PROVNUM FROM pbj) LEFT JOIN prov ON PROVNUM = CCN", "pbj", "prov"),
    "unmatched_ids": sql(
        "SELECT DISTINCT PROVNUM FROM pbj WHERE PROVNUM NOT IN (SELECT CCN FROM prov) "
        "ORDER BY 1 LIMIT 10", "pbj", "prov"),
    "silver": sql(f"SELECT {_SILVER_COLUMNS} FROM silver", "silver"),
    "daily_ratios": sql(
        "SELECT PROVNUM, WorkDate, CNA_hrs_per_patient, RN_hrs_per_patient, LPN_hrs_per_patient, "
        "total_hrs_per_patient, contracted_rn_ratio, bed_occupancy_rate FROM daily", "daily"),
    "staffing_tier": sql(
        "SELECT PROVNUM, WorkDate, cna AS CNA_hrs_per_patient, staffing_tier FROM silver", "silver"),
    "daily_compliance": sql(
        "SELECT PROVNUM, WorkDate, meets_cms_minimums, day_of_week, is_weekend FROM daily", "daily"),
    "staffing_metrics": sql(f"SELECT {_DAILY_COLUMNS} FROM daily", "daily"),
    "shift_quarter": sql(_SHIFT.format(
        day="CASE WHEN (month(WorkDate) = 4) OR (month(WorkDate) IN (5, 6) AND day(WorkDate) <= 10) "
            "THEN WorkDate + INTERVAL 3 MONTH ELSE WorkDate END"), "pbj"),
    "shift_quarter_full": sql(_SHIFT.format(day="WorkDate + INTERVAL 3 MONTH"), "pbj"),
    "facility_summary": sql("SELECT * FROM facility", "facility"),
    "tier_distribution": sql("SELECT staffing_tier, count(*) AS days FROM silver GROUP BY 1", "silver"),
    "tier_by_quarter": sql(
        "SELECT quarter, staffing_tier, count(*) AS days FROM silver GROUP BY 1, 2", "silver"),
    "chronic_by_state": sql(
        "SELECT STATE, count(*) AS facilities FROM facility WHERE chronically_understaffed "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "facility"),
    "facility_compliance_rate": sql(
        "SELECT count(*) AS total, count(*) FILTER (NOT chronically_understaffed) AS compliant, "
        f"{pct_up('count(*) FILTER (NOT chronically_understaffed)', 'count(*)', 1)} AS compliant_pct "
        "FROM facility", "facility"),
    "daily_compliance_rate": sql(
        "SELECT count(*) AS days, count(*) FILTER (meets_cms_minimums) AS days_meeting, "
        f"{pct_up('count(*) FILTER (meets_cms_minimums)', 'count(*)', 1)} AS meeting_pct FROM daily",
        "daily"),
    "facility_filter": sql("SELECT * FROM picked WHERE chronically_understaffed", "picked"),
    "filter_options": sql(
        "SELECT DISTINCT 'STATE' AS filter, STATE AS value FROM facility WHERE STATE IS NOT NULL UNION ALL "
        "SELECT DISTINCT 'ownership_type', ownership_type FROM facility WHERE ownership_type IS NOT NULL",
        "facility"),
    "filter_summary": sql(
        "SELECT count(*) AS facilities_shown, count(DISTINCT STATE) AS states_selected, "
        "max(quarter) AS quarter FROM picked", "picked"),
    "kpi_cards": sql(f"""SELECT *, avg_cna - CAST(2.45 AS DOUBLE) AS cna_vs_minimum,
  avg_rn - CAST(0.55 AS DOUBLE) AS rn_vs_minimum, avg_total - CAST(3.48 AS DOUBLE) AS total_vs_minimum FROM (
  SELECT count(*) AS facilities,
    100.0::DOUBLE * count(*) FILTER (pct_days_meeting_cms >= 50) / count(*) AS pct_meeting,
    count(*) FILTER (chronically_understaffed) AS chronic,
    100.0::DOUBLE * count(*) FILTER (chronically_understaffed) / count(*) AS pct_chronic,
    {mean("avg_CNA_hrs_per_patient")} AS avg_cna, {mean("avg_RN_hrs_per_patient")} AS avg_rn,
    {mean("avg_total_hrs_per_patient")} AS avg_total,
    {mean("avg_bed_occupancy_rate")} * 100 AS avg_occupancy_pct,
    {mean("avg_contracted_rn_ratio")} * 100 AS avg_contracted_pct,
    {mean("weekend_staffing_gap")} AS avg_weekend_gap FROM shown)""", "shown"),
    "q1_scatter": sql(
        "SELECT PROVNAME, STATE, ownership_type, avg_bed_occupancy_rate, avg_CNA_hrs_per_patient, "
        "chronically_understaffed FROM shown WHERE avg_bed_occupancy_rate <= 1", "shown"),
    "contract_by_state": sql(f"""SELECT STATE, {mean("avg_contracted_rn_ratio")} AS avg_contracted,
  {sum_up("total_employed_RN_hours", 1)} AS avg_employed, {sum_up("total_contracted_RN_hours", 1)} AS avg_contract_hrs,
  count(PROVNUM) AS facility_count,
  {_half_even(_units("avg_contracted_rn_ratio"), f"count(avg_contracted_rn_ratio)*{10 ** (_SCALE - 3)}", 1)} AS contracted_pct
FROM shown GROUP BY 1 ORDER BY contracted_pct DESC, STATE LIMIT 20""", "shown"),
    "cna_by_state": sql(
        f"SELECT STATE, {mean('avg_CNA_hrs_per_patient')} AS avg_cna, count(PROVNUM) AS facility_count "
        "FROM shown GROUP BY 1 ORDER BY 2, 1 LIMIT 15", "shown"),
    "cna_by_ownership": sql(
        f"SELECT ownership_type, {mean('avg_CNA_hrs_per_patient')} AS avg_cna, "
        "count(PROVNUM) AS facility_count FROM shown GROUP BY 1", "shown"),
    "weekly_trend": sql(_TREND.format(where=""), "daily"),
    "weekly_trend_long": sql(
        "SELECT week, unnest(['CNA', 'RN', 'Total Nurses']) AS staff_type, "
        "unnest([avg_cna, avg_rn, avg_total]) AS hrs_per_patient FROM ("
        + _TREND.format(where=f"WHERE STATE IN ({_quoted(SOME_STATES)})") + ")", "daily"),
    "drill_down": sql("SELECT * FROM drill", "drill"),
    "worst_facilities": sql(
        "SELECT PROVNAME, STATE, avg_CNA_hrs_per_patient, pct_days_meeting_cms, avg_daily_census "
        "FROM facility WHERE chronically_understaffed ORDER BY pct_days_meeting_cms, PROVNUM, quarter LIMIT 10",
        "facility"),
    "identity_profile": sql(
        "SELECT count(DISTINCT PROVNUM) AS facilities, count(DISTINCT STATE) AS states, "
        "count(DISTINCT CY_Qtr) AS quarters, min(WorkDate) AS first_day, max(WorkDate) AS last_day FROM pbj",
        "pbj"),
    "identity_from_bitmaps": sql(_each([
        f"SELECT '{kind}' AS kind, count(DISTINCT {kind}) AS \"distinct\", '{scope}' AS scope FROM pbj {where}"
        for kind in ("PROVNUM", "STATE", "CITY") for scope, where in (("all", ""), (SCAN_QUARTER, f"WHERE CY_Qtr = '{SCAN_QUARTER}'"))]), "pbj"),
    "state_list": sql("SELECT DISTINCT STATE FROM pbj", "pbj"),
    "quarter_list": sql("SELECT DISTINCT CY_Qtr FROM pbj", "pbj"),
    "duplicate_keys": sql(
        "SELECT PROVNUM, WorkDate, count(*) AS rows FROM (SELECT PROVNUM, WorkDate FROM pbj_f UNION ALL "
        "SELECT PROVNUM, WorkDate FROM pbj_o) GROUP BY 1, 2 HAVING count(*) > 1", "pbj_f", "pbj_o"),
    "missing_report": sql("SELECT * FROM (" + _each([
        f"SELECT '{n}' AS column_name, count(*) - count({n}) AS missing_count, "
        f"{pct_even(f'(count(*) - count({n}))', 'count(*)', 2)} AS missing_pct FROM typed"
        for n in STAFFING_COLUMNS]) + ") WHERE missing_count > 0", "typed"),
    "zero_report": sql(_each([
        f"SELECT '{n}' AS column_name, count(*) FILTER ({n} = 0) AS zero_count, "
        f"{pct_even(f'count(*) FILTER ({n} = 0)', 'count(*)', 1)} AS zero_pct, "
        f"CASE WHEN count(*) FILTER ({n} = 0) = count(*) THEN 0.0::DOUBLE ELSE "
        f"{mean_even(f'CASE WHEN {n} > 0 THEN {n} END', 2)} END AS mean_nonzero FROM pbj"
        for n in HOUR_COLUMNS]), "pbj"),
    "describe_stats": sql(_each([_describe(n) for n in STATS_COLUMNS]), "pbj"),
    "outlier_check": sql(_each([
        f"SELECT '{n}' AS column_name, max({n}) AS max_value, count(*) FILTER ({n} > 500) AS rows_over FROM pbj"
        for n in STATS_COLUMNS[1:]]), "pbj"),
    "facilities_per_state": sql(
        "SELECT STATE, count(DISTINCT PROVNUM) AS facilities FROM pbj GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
        "pbj"),
    "census_histogram": sql("""SELECT CAST(b AS BIGINT) AS bin,
  CAST(lo AS DOUBLE) + CAST(hi-lo AS DOUBLE)/50*b AS bin_from,
  CAST(lo AS DOUBLE) + CAST(hi-lo AS DOUBLE)/50*(b+1) AS bin_to,
  (SELECT count(*) FROM pbj WHERE least((least(MDScensus,300)-lo)*50 // (hi-lo), 49) = b) AS days
FROM range(50) r(b), (SELECT min(least(MDScensus,300)) AS lo, max(least(MDScensus,300)) AS hi FROM pbj)""", "pbj"),
    "hours_by_type": sql(_each([
        f"SELECT '{label}' AS nurse_type, {mean(n)} AS avg_hours FROM pbj"
        for label, n in NURSE_TYPE_LABELS.items()]), "pbj"),
    "tier_profile": sql(
        f"SELECT {_TIER_OF} AS staffing_tier, count(*) AS days FROM typed GROUP BY 1", "typed"),
    "tier_pass_rate": sql(
        f"SELECT count(*) AS days, {_PASSING} AS days_passing, {pct_up(_PASSING, 'count(*)', 1)} AS pass_pct "
        f"FROM (SELECT {_TIER_OF} AS tier FROM pbj)", "pbj"),
    "chronic_offenders": sql(
        f"SELECT PROVNUM, PROVNAME, STATE, count(WorkDate) AS days_below_minimum, "
        f"{mean(_RATIO, True)} AS avg_CNA_ratio, {mean('MDScensus')} AS avg_patients FROM pbj "
        f"WHERE {_TIER_OF} IN ('critical_no_staff', 'critical_understaffed', 'below_cms_minimum') "
        "GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1 LIMIT 15", "pbj"),
    "facility_means": sql(_FACILITY_MEANS, "pbj"),
    "incremental_audit": sql(f"SELECT {_JOINED_COLUMNS} FROM typed_joined WHERE CCN IS NULL", "typed_joined"),
    "audit_table": sql(f"SELECT {_JOINED_COLUMNS} FROM joined WHERE CCN IS NULL", "joined"),
    "gold_scan": sql(
        "SELECT facility.*, n AS stored_days FROM facility JOIN (SELECT PROVNUM, quarter, count(WorkDate) AS n "
        "FROM daily GROUP BY 1, 2) USING (PROVNUM, quarter)", "facility", "daily"),
    "table_size": sql('SELECT count(*) AS "rows", CAST(30 AS INTEGER) AS "columns" FROM facility', "facility"),
    "schema_contract": sql(_each([
        f"SELECT '{n}' AS column_name, "
        + ("'missing' AS status, CAST(NULL AS BIGINT) AS filled_rows" if n == "provider_type" else
           f"'ok' AS status, (SELECT count({source}) FROM silver) AS filled_rows")
        for n, source in [*((c, c) for c in [*STAFFING_COLUMNS, *_PROVIDER_NAMES]), ("CNA_hrs_per_patient", "cna"), ("RN_hrs_per_patient", "rn"),
                          ("total_hrs_per_patient", "total"), ("contracted_rn_ratio", "ctr"), ("staffing_tier", "staffing_tier"), ("quarter", "quarter")]
    ] + ["SELECT 'surprise' AS column_name, 'unexpected' AS status, (SELECT count(*) FROM silver) AS filled_rows"]), "silver"),
    "provider_conflicts": sql(f"""
SELECT CCN, count(*) AS rows, count(DISTINCT ({', '.join(f"coalesce(CAST({n} AS VARCHAR), '')" for n in _PROVIDER_NAMES[1:])})) AS variants,
  concat_ws(',', {', '.join(f"CASE WHEN min({n}) <> max({n}) OR (count({n}) > 0 AND count({n}) < count(*)) THEN '{n}' END" for n in _PROVIDER_NAMES[1:])}) AS conflicts
FROM listed GROUP BY CCN HAVING count(*) > 1""", "listed"),
    "join_unique_provider": sql(f"SELECT {_JOINED_COLUMNS} FROM pbj LEFT JOIN unique_prov ON PROVNUM = CCN WHERE MDScensus >= 10", "pbj", "unique_prov"),
    "landed_files": sql("""
SELECT fresh.quarter, f.name, octet_length(encode(line)) AS length, sha256(line) AS sha256
FROM (SELECT regexp_replace(name, '-[0-9]+\\.csv$', '.csv') AS name, quarter, count(*) || ',' || sum(id) || chr(10) AS line FROM files GROUP BY 1, 2) f
JOIN fresh ON f.quarter IS NULL OR f.quarter = fresh.quarter""", "files", "fresh"),
    "audit_reconciled": sql("""
SELECT CY_Qtr, count(*) AS raw_rows, count(*) - count(*) FILTER (MDScensus >= 10) AS excluded_rows,
  count(*) FILTER (MDScensus >= 10 AND CCN IS NOT NULL) AS silver_rows, count(*) FILTER (MDScensus >= 10 AND CCN IS NULL) AS audit_rows, true AS balanced
FROM typed LEFT JOIN prov ON PROVNUM = CCN WHERE WorkDate IS NOT NULL GROUP BY CY_Qtr""", "typed", "prov"),
    "quality_correlations": sql(f"""
SELECT quarter, measure, quality, facilities,
  CASE WHEN d > 0 THEN {up("CASE WHEN d > 0 THEN CAST(facilities*sxy - sx*sy AS DOUBLE) / d END", 6)} END AS rank_correlation
FROM (SELECT *, sqrt(CAST(facilities*sxx - sx*sx AS DOUBLE)) * sqrt(CAST(facilities*syy - sy*sy AS DOUBLE)) AS d FROM (
  SELECT quarter, measure, quality, count(*) AS facilities, sum(rx) AS sx, sum(ry) AS sy, sum(rx*ry) AS sxy, sum(rx*rx) AS sxx, sum(ry*ry) AS syy FROM (
    SELECT quarter, measure, quality,
      CAST(2*rank() OVER (PARTITION BY quarter, measure, quality ORDER BY x) + count(*) OVER (PARTITION BY quarter, measure, quality, x) - 1 AS HUGEINT) AS rx,
      CAST(2*rank() OVER (PARTITION BY quarter, measure, quality ORDER BY y) + count(*) OVER (PARTITION BY quarter, measure, quality, y) - 1 AS HUGEINT) AS ry
    FROM ({_each([f"SELECT quarter, '{m}' AS measure, '{q}' AS quality, {m} AS x, {q} AS y FROM facility" for m in CORRELATED_MEASURES for q in CORRELATED_QUALITIES])})
    WHERE x IS NOT NULL AND y IS NOT NULL) GROUP BY 1, 2, 3))""", "facility"),
    "discover_files": sql(
        "SELECT DISTINCT name, fresh.quarter FROM (SELECT regexp_replace(name, '-[0-9]+\\.csv$', '.csv') AS name, quarter "
        "FROM files) f JOIN fresh ON f.quarter IS NULL OR f.quarter = fresh.quarter", "files", "fresh"),
    "generated_quarter": sql(
        "SELECT * REPLACE (CAST(CASE WHEN (month(WorkDate) = 4) OR (month(WorkDate) IN (5, 6) AND day(WorkDate) <= 10) "
        f"THEN WorkDate + INTERVAL 3 MONTH ELSE WorkDate END AS DATE) AS WorkDate, '{SHIFTED_LABEL}' AS CY_Qtr) "
        f"FROM (SELECT * FROM pbj ORDER BY PROVNUM, WorkDate LIMIT {SAMPLE_ROWS})", "pbj"),
    "incremental_load": sql(f"SELECT {_SILVER_COLUMNS} FROM typed_silver", "typed_silver"),
    "staffing_rating_corr": sql(
        "SELECT count(*) AS facilities, "
        + ", ".join(f"{up(f'corr({n}, overall_rating)', 6)} AS corr_{n}"
                    for n in ("avg_CNA_ratio", "avg_RN_ratio", "avg_total_ratio"))
        + f" FROM ({_FACILITY_MEANS}) JOIN prov ON PROVNUM = CCN", "pbj", "prov"),
}
ORACLE["validate_facility_summary"] = ORACLE["facility_compliance_rate"]
ORACLE["validate_staffing_metrics"] = ORACLE["daily_compliance_rate"]
