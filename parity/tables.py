"""Staffing-shaped tables derived, in Spark, from the driver's tables.

A supplier is a facility and a shipping day a working day. All hours are integer sums
divided by a power of two, so they are exact in any engine and in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.config import HOUR_COLUMNS, PROVIDER_FIELDS, STAFFING_COLUMNS, TablePaths
from rosterlake.functions.calendar import quarter_label
from rosterlake.operators.clean import enough_census, join_provider
from rosterlake.operators.joins import fits_broadcast
from rosterlake.plans.gold import daily_metrics, facility_summary, staffing_metrics
from rosterlake.plans.silver import SILVER_PARTITIONS, build_silver
from rosterlake.session import scratch_dir
from rosterlake.sinks.tables import create_table
from rosterlake.sources.tables import read_table


#: Order lines that one task folds to facility-days, about; and those that become one landed file.
LINES_PER_TASK, LINES_PER_FILE = 250_000, 500_000


def _facility_id(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 6, "0")


def hours_text(name: str) -> Column:
    """Hours as text with eight decimals, as ``decimal(18,8)`` writes them.

    Hours that are whole hundred-millionths go by way of a long; what is finer or not below ten million hours, by way of the
    decimal, which takes twice as long. Its array keeps 24 such columns out of one generated method, too long for the JVM to compile.
    """
    scaled = F.abs(F.col(name)) * 1e8
    units = scaled.cast("bigint")
    short = F.concat(
        F.when(F.col(name) < 0, "-").otherwise(""), F.floor(units / F.lit(100_000_000)).cast("string"), F.lit("."),
        F.substring((units % 100_000_000 + 100_000_000).cast("string"), 2, 8),
    )
    return F.when((scaled < 1e15) & (scaled == F.rint(scaled)), short).otherwise(
        F.transform(F.array(name), lambda value: value.cast("decimal(18,8)").cast("string"))[0]
    )


class Tables:
    """The layers over one data folder. Methods only build plans, but for those that measure the input once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._small: bool | None = None
        self._places_small: bool | None = None
        self._lines: int | None = None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def line_parts(self, size: int | None = None) -> int:
        """Into how many parts of ``size`` lines the order lines go: they are counted once, from the file footers."""
        if self._lines is None:
            self._lines = self.read("lineitem").count()
        return max(self.spark.sparkContext.defaultParallelism, -(-self._lines // (size or LINES_PER_TASK)))

    # --- bronze -------------------------------------------------------------

    def _facility_days(self, delivery: str | None, by_quarter: bool = False) -> DataFrame:
        """Order lines folded to facility-days.

        Nearly each line is a day of its own, so they travel as they are, a facility's quarter to one task, and a task
        gets as many however large the table is: its memory stays the same, and what a later step groups by facility and
        quarter is together. ``by_quarter`` gives each task a range of quarters and facilities, so that rows which are
        written by quarter need not travel again, as wide text.
        """
        lines = self.read("lineitem")
        if delivery is not None:
            lines = lines.filter(F.col("l_linestatus") == delivery)
        lines = lines.withColumns({
            "q": F.col("l_quantity").cast("bigint"),
            "d": F.rint(F.col("l_discount") * 100).cast("bigint"),
            "t": F.rint(F.col("l_tax") * 100).cast("bigint"),
            "day": F.col("l_shipdate").cast("date"),
        })
        lines = lines.select(
            "l_suppkey", "day", F.trunc("day", "quarter").alias("in_quarter"), "q", "d", "t", "l_linestatus", "l_returnflag",
            "l_linenumber", (F.col("l_partkey") % 8).alias("p8"), (F.col("l_orderkey") % 16).alias("o16"),
        )
        if by_quarter:
            lines = lines.repartitionByRange(self.line_parts(LINES_PER_FILE), "in_quarter", "l_suppkey")
        else:
            lines = lines.repartition(self.line_parts(), "l_suppkey", "in_quarter")
        qty, disc, tax = F.col("q"), F.col("d"), F.col("t")

        def only(flag: str, value: str, amount: Column) -> Column:
            return F.sum(F.when(F.col(flag) == value, amount).otherwise(F.lit(0)))

        return lines.groupBy("l_suppkey", "in_quarter", F.col("day").alias("WorkDate")).agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(qty).alias("qty"),
            only("l_linestatus", "F", qty).alias("qty_f"),
            F.sum(qty * disc).alias("disc"),
            only("l_returnflag", "R", qty * disc).alias("disc_r"),
            only("l_linestatus", "F", qty * disc).alias("disc_f"),
            F.sum(qty * tax).alias("tax"),
            only("l_returnflag", "R", qty * tax).alias("tax_r"),
            F.sum("l_linenumber").alias("lineno"),
            only("l_returnflag", "A", F.col("l_linenumber").cast("bigint")).alias("lineno_a"),
            F.sum("p8").alias("part"),
            only("l_linestatus", "F", F.col("p8")).alias("part_f"),
            F.sum(F.when(disc == 0, tax).otherwise(F.lit(0))).alias("untaxed"),
            F.sum("o16").alias("order"),
            only("l_returnflag", "A", F.col("o16")).alias("order_a"),
        )

    def places(self) -> DataFrame:
        """Facility names and where they are. Broadcast inside the measured bounds of a lookup: the planner takes a join for
        the product of its sides, and adaptive planning stops at 10 MB (about 100,000 facilities), from where on all
        facility-days would be shuffled and sorted once more."""
        places = (
            self.read("supplier")
            .join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", "s_name", "n_nationkey", "n_name", "r_name")
        )
        if self._places_small is None:
            self._places_small = fits_broadcast(places)
        return F.broadcast(places) if self._places_small else places

    def staffing(self, delivery: str | None = None, by_quarter: bool = False) -> DataFrame:
        """Typed staffing rows, one per facility-day.

        Order lines fold to facility-days before they meet the facility names.
        ``delivery`` picks one of two deliveries ('F' or 'O'), which overlap in keys; ``by_quarter``: see ``_facility_days``.
        """
        days = self._facility_days(delivery, by_quarter)
        places = self.places()
        zero = F.lit(0).cast("bigint")
        has_aides = F.col("l_suppkey") % 7 != 2
        # role -> (all hours, contract hours, divisor)
        hours = {
            "RNDON": (F.col("lines") * 8, zero, 1),
            "RNadmin": (F.col("lineno"), F.col("lineno_a"), 4),
            # up to six decimals, finer than the whole units that sums are kept in
            "RN": (F.col("tax") * 8 + F.col("lineno"), F.col("tax_r") * 8 + F.col("lineno_a"), 64),
            "LPNadmin": (F.col("part"), F.col("part_f"), 2),
            "LPN": (F.col("qty") * 10 - F.col("disc"), F.col("qty_f") * 10 - F.col("disc_f"), 8),
            "CNA": (F.col("disc"), F.col("disc_r"), 2),
            "NAtrn": (F.col("untaxed"), zero, 4),
            "MedAide": (F.when(has_aides, F.col("order")), F.when(has_aides, F.col("order_a")), 4),
        }
        columns = {
            "PROVNUM": _facility_id("l_suppkey"),
            "PROVNAME": F.col("s_name"),
            "CITY": F.col("r_name"),
            "STATE": F.col("n_name"),
            "COUNTY_NAME": F.concat(F.lit("Cañon "), F.col("n_name")),
            "COUNTY_FIPS": F.lpad(F.col("n_nationkey").cast("string"), 3, "0"),
            "CY_Qtr": quarter_label(F.col("WorkDate")),
            "WorkDate": F.col("WorkDate"),
            "MDScensus": F.col("qty").cast("int"),
        }
        for role, (total, contract, divisor) in hours.items():
            columns[f"Hrs_{role}"] = total.cast("double") / divisor
            columns[f"Hrs_{role}_emp"] = (total - contract).cast("double") / divisor
            columns[f"Hrs_{role}_ctr"] = contract.cast("double") / divisor
        return days.join(places, days["l_suppkey"] == places["s_suppkey"]).select(
            *[columns[name].alias(name) for name in STAFFING_COLUMNS]
        )

    def staffing_text(self, by_quarter: bool = False) -> DataFrame:
        """The same rows as a CSV would hold them: text, some censuses written
        as ``72.0`` or left empty, the 31st of a month unreadable."""
        day = F.dayofmonth("WorkDate")
        census = F.col("MDScensus").cast("string")
        text = {name: hours_text(name) for name in HOUR_COLUMNS}
        text["MDScensus"] = (
            F.when(day % 10 == 7, F.lit(None))
            .when(day % 10 == 3, F.concat(census, F.lit(".0")))
            .otherwise(census)
        )
        text["WorkDate"] = F.when(day == 31, F.lit("n/a")).otherwise(
            F.date_format("WorkDate", "yyyyMMdd")
        )
        return self.staffing(by_quarter=by_quarter).withColumns(text)

    def provider_text(self) -> DataFrame:
        """The provider file: text under its published headers, plus one nobody reads."""
        provider = self.provider()
        return provider.select(
            F.col("CCN").alias("CMS Certification Number (CCN)"),
            F.lit("unused").alias("Provider Address"),
            *[
                F.col(name).cast("string").alias(header)
                for header, (name, _) in PROVIDER_FIELDS.items()
                if name != "CCN"
            ],
        )

    def provider(self) -> DataFrame:
        """Provider attributes. Facilities with a low balance are missing, and some
        have no bed count."""
        key = F.col("s_suppkey")
        owner = F.col("s_nationkey") % 3
        return (
            self.read("supplier")
            .filter(F.col("s_acctbal") >= 1000)
            .select(
                _facility_id("s_suppkey").alias("CCN"),
                F.when(owner == 0, "For profit - Corporation")
                .when(owner == 1, "Government - County")
                .otherwise("Non profit - Other").alias("ownership_type"),
                F.when(key % 2 == 0, "Medicare and Medicaid").otherwise("Medicare")
                .alias("provider_type"),
                F.when(key % 13 != 5, (key * 7 % 60 + 40).cast("double")).alias("certified_beds"),
                (key % 5 + 1).cast("double").alias("overall_rating"),
                (key * 3 % 5 + 1).cast("double").alias("staffing_rating"),
                (key * 11 % 100).cast("double").alias("nursing_turnover"),
                ((key % 9).cast("double") / 8).alias("reported_rn_hrs"),
                ((key % 23).cast("double") / 8).alias("reported_cna_hrs"),
            )
        )

    def provider_listed(self) -> DataFrame:
        """The provider attributes as an untidy file lists them: some facilities again with another rating, some
        again without beds, some twice alike."""
        rows, key = self.provider(), F.col("CCN").cast("int")
        return (
            rows.unionByName(rows.filter(key % 10 == 3).withColumn("overall_rating", F.col("overall_rating") + 1))
            .unionByName(rows.filter(key % 10 == 7).withColumn("certified_beds", F.lit(None).cast("double")))
            .unionByName(rows.filter(key % 25 == 4))
        )

    def provider_is_small(self) -> bool:
        """Measured once for these tables."""
        if self._small is None:
            self._small = fits_broadcast(self.provider())
        return self._small

    def manifest(self) -> DataFrame:
        """A list of offered files, one per order: dated staffing files, undated and dated
        supporting files, and staffing files with an unreadable quarter."""
        day = F.col("o_orderdate").cast("date")
        year, quarter = F.year(day).cast("string"), F.quarter(day).cast("string")
        number = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
        dated = F.concat(F.lit("Q"), quarter, F.lit("_"), year)
        kind = F.col("o_orderkey") % 5
        stem = (
            F.when(kind == 1, F.concat(F.lit("NH_ProviderInfo_Oct"), year))
            .when(kind == 2, F.concat(F.lit("NH_QualityMsr_Claims_"), dated))
            .when(kind == 3, F.concat(F.lit("PBJ_Daily_Nurse_Staffing_"), year, F.lit("Q"), quarter))
            .otherwise(F.concat(F.lit("PBJ_Daily_Nurse_Staffing_"), dated))
        )
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.concat(stem, F.lit("-"), number, F.lit(".csv")).alias("name"),
        )

    def landed_quarters(self) -> DataFrame:
        """Quarters with orders before 2000: what an earlier run has landed."""
        day = F.col("o_orderdate").cast("date")
        return (
            self.read("orders")
            .filter(day < F.lit("2000-01-01").cast("date"))
            .select(quarter_label(day).alias("quarter"))
            .distinct()
        )

    # --- silver and gold --------------------------------------------------------

    def joined(self) -> DataFrame:
        return join_provider(
            enough_census(self.staffing()), self.provider(), self.provider_is_small()
        )

    def silver(self, delivery: str | None = None) -> DataFrame:
        return build_silver(
            self.staffing(delivery), self.provider(), quarter_label(F.col("WorkDate")),
            self.provider_is_small(),
        )

    def daily(self) -> DataFrame:
        return daily_metrics(self.silver())

    def metrics(self, delivery: str | None = None) -> DataFrame:
        return staffing_metrics(self.silver(delivery))

    def facilities(self, delivery: str | None = None) -> DataFrame:
        return facility_summary(self.silver(delivery))


class StoredTables(Tables):
    """The same layers with Silver and both Gold tables written once and read back, as a dashboard has them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.paths = TablePaths(*[scratch_dir(spark, name) for name in ("bronze", "silver", "gold", "audit")])
        create_table(super().staffing(), self.paths.bronze, ["CY_Qtr"])
        create_table(super().silver(), self.paths.silver, SILVER_PARTITIONS)
        create_table(super().metrics(), self.paths.staffing_metrics, SILVER_PARTITIONS)
        create_table(super().facilities(), self.paths.facility_summary, ["quarter"])

    def _stored(self, path: str) -> DataFrame:
        return read_table(self.spark, path)

    def staffing(self, delivery: str | None = None, by_quarter: bool = False) -> DataFrame:
        return super().staffing(delivery, by_quarter) if delivery or by_quarter else self._stored(self.paths.bronze)

    def silver(self, delivery: str | None = None) -> DataFrame:
        return super().silver(delivery) if delivery else self._stored(self.paths.silver)

    def metrics(self, delivery: str | None = None) -> DataFrame:
        return super().metrics(delivery) if delivery else self._stored(self.paths.staffing_metrics)

    def facilities(self, delivery: str | None = None) -> DataFrame:
        return super().facilities(delivery) if delivery else self._stored(self.paths.facility_summary)
