"""A next-quarter test delivery made from an existing one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.config import CSV_ENCODING, STAFFING_COLUMNS
from rosterlake.functions.calendar import shift_one_quarter
from rosterlake.operators.profile import first_rows


def shift_quarter(
    staffing: DataFrame, label: str, every_day: bool = False, year: int | None = None
) -> DataFrame:
    """Typed staffing rows moved one quarter on and relabelled ``label``."""
    return staffing.withColumns({
        "WorkDate": shift_one_quarter(F.col("WorkDate"), every_day, year),
        "CY_Qtr": F.lit(label),
    })


def write_next_quarter(
    staffing: DataFrame,
    path: str,
    label: str,
    rows: int | None = 5000,
    every_day: bool = False,
    year: int | None = None,
) -> None:
    """A test delivery: the first ``rows`` of typed staffing rows (None: all), moved one quarter on, written
    as the CSV text that ``scan_staffing`` reads. Hours keep up to eight decimals."""
    taken = staffing if rows is None else first_rows(staffing, rows)
    moved = shift_quarter(taken, label, every_day, year).select(*STAFFING_COLUMNS)
    text = {
        name: F.col(name).cast("decimal(28,8)").cast("string") for name, kind in moved.dtypes if kind == "double"
    }
    text["WorkDate"] = F.date_format("WorkDate", "yyyyMMdd")
    (
        moved.withColumns(text).write.mode("overwrite").option("header", True)
        .option("encoding", CSV_ENCODING).option("escape", '"').csv(path)
    )
