import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rosterlake.config import HOUR_COLUMNS, STAFFING_COLUMNS  # noqa: E402
from rosterlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SILVER_SCHEMA = ", ".join([
    "PROVNUM string", "PROVNAME string", "CITY string", "STATE string", "WorkDate date",
    "MDScensus int", "Hrs_RN double", "Hrs_RN_emp double", "Hrs_RN_ctr double",
    "Hrs_LPN double", "Hrs_CNA double", "ownership_type string", "provider_type string",
    "certified_beds double", "overall_rating double", "staffing_rating double",
    "nursing_turnover double", "staffing_tier string", "quarter string",
])
SILVER_DEFAULTS = {
    "PROVNUM": "015009", "PROVNAME": "Home", "CITY": "Town", "STATE": "AL", "MDScensus": 100,
    "Hrs_RN": 60.0, "Hrs_RN_emp": 50.0, "Hrs_RN_ctr": 10.0, "Hrs_LPN": 80.0, "Hrs_CNA": 250.0,
    "ownership_type": "For profit", "provider_type": "Medicare", "certified_beds": 120.0,
    "overall_rating": 3.0, "staffing_rating": 2.0, "nursing_turnover": 50.0,
    "staffing_tier": "meets_cms_minimum", "quarter": "2024Q2",
}


@pytest.fixture(scope="session")
def silver_of(spark):
    """Silver rows from partial dicts; the rest takes a compliant default."""
    names = [part.split()[0] for part in SILVER_SCHEMA.split(", ")]

    def build(*rows):
        full = [{"WorkDate": None, **SILVER_DEFAULTS, **row} for row in rows]
        return spark.createDataFrame([tuple(row[n] for n in names) for row in full], SILVER_SCHEMA)

    return build


STAFFING_SCHEMA = ", ".join(
    f"{name} {'double' if name in HOUR_COLUMNS else {'WorkDate': 'date', 'MDScensus': 'int'}.get(name, 'string')}"
    for name in STAFFING_COLUMNS
)


@pytest.fixture(scope="session")
def staffing_of(spark):
    def build(*rows):
        base = {name: 0.0 for name in HOUR_COLUMNS} | {
            "PROVNUM": "015009", "PROVNAME": "Home", "CITY": "Town", "STATE": "AL",
            "COUNTY_NAME": "County", "COUNTY_FIPS": "001", "CY_Qtr": "2024Q2",
            "WorkDate": None, "MDScensus": 50,
        }
        full = [{**base, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(row[n] for n in STAFFING_COLUMNS) for row in full], STAFFING_SCHEMA
        )

    return build
