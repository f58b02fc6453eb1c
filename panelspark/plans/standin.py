"""The driver tables in the roles of the reference's panel data.

record      one ``lineitem`` row; repeated key ``(l_orderkey, l_linenumber)``
target      ``l_extendedprice``
measures    ``l_quantity``, ``l_discount``, ``l_tax``
codes       ``l_returnflag``, ``l_linestatus``, priority code (first character
            of ``o_orderpriority``, through the orders join)
period      year of ``l_shipdate``: one "period file" per year; development
            years before the holdout year
dirt        a text column built from the key (NULL, blank, junk text, padded
            number, ``nan``, float-formatted code), since the tables hold no
            missing values

Every frame here is a lazy projection of the given tables; each DuckDB
fragment next to it is the same expression for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.columns import to_double
from panelspark.operators.funnel import Rule
from panelspark.functions.columns import is_finite, is_integer_between
from panelspark.sources.manifest import Listing

# --- fixed values of the stand-in -------------------------------------------
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
HOLDOUT_YEAR = 2001
OTHER = "other"  # the period of rows that no listed year holds
RETURNFLAG_LABELS = {"A": "Accepted", "N": "Not returned", "R": "Returned"}
LINESTATUS_LABELS = {"F": "Filled", "O": "Open"}
PRIORITY_LABELS = {"1": "Urgent", "2": "High", "3": "Medium", "4": "Not specified"}
# Rows per yearly slice of lineitem at sf0.01 (the "published" counts the
# manifest audit checks; other scales report ok = false).
EXPECTED_ROWS_SF001 = {1995: 8840, 1996: 8931, 1997: 8715, 1998: 8900, 1999: 8589,
                       2000: 8762, 2001: 7263}
SPLIT_SALT = "42"
# ---------------------------------------------------------------------------

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate"]
SAMPLE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- dirt -------------------------------------------------------------------

def dirty_text() -> Column:
    k = F.col("l_orderkey")
    line = F.col("l_linenumber").cast("string")
    return (F.when(k % 11 == 0, F.lit(None).cast("string"))
            .when(k % 13 == 0, F.lit(""))
            .when(k % 17 == 0, F.lit("n/a"))
            .when(k % 19 == 0, F.lit(" 12 "))
            .when(k % 23 == 0, F.lit("nan"))
            .when(k % 29 == 0, F.concat(line, F.lit(".0")))
            .otherwise(line))


DIRTY_SQL = ("CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN '' "
             "WHEN l_orderkey % 17 = 0 THEN 'n/a' WHEN l_orderkey % 19 = 0 THEN ' 12 ' "
             "WHEN l_orderkey % 23 = 0 THEN 'nan' "
             "WHEN l_orderkey % 29 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.0' "
             "ELSE CAST(l_linenumber AS VARCHAR) END")


# ---- frames -----------------------------------------------------------------

def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem + period + dirt (no join)."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumns({
        "year": F.year("l_shipdate"),
        "period": F.year("l_shipdate").cast("string"),
        "ship_quarter": F.quarter("l_shipdate"),
        "dirty": dirty_text(),
    })


LINES_SQL = (f"SELECT *, CAST(year(l_shipdate) AS INTEGER) AS year, "
             f"CAST(year(l_shipdate) AS VARCHAR) AS period, "
             f"CAST(quarter(l_shipdate) AS INTEGER) AS ship_quarter, {DIRTY_SQL} AS dirty "
             f"FROM lineitem")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines joined to the order's priority code (a shuffle join on the
    order key; only four order columns are read)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority_code"), "o_orderstatus", "o_orderdate")
    return lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


RECORDS_SQL = (f"SELECT l.*, substr(o.o_orderpriority, 1, 1) AS priority_code, o.o_orderstatus, o.o_orderdate "
               f"FROM ({LINES_SQL}) l JOIN orders o ON l.l_orderkey = o.o_orderkey")


def with_shipping_measures(df: DataFrame) -> DataFrame:
    """``charge`` (what the line costs with discount and tax), ``parcels`` (a
    number read from the dirty text) and ``days_to_ship`` after the order."""
    return df.withColumns({
        "charge": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        "parcels": to_double("dirty"),
        "days_to_ship": F.date_diff("l_shipdate", "o_orderdate"),
    })


MEASURES_SQL = ("l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, "
                "TRY_CAST(dirty AS DOUBLE) AS parcels, "
                "CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days_to_ship")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shipping_measures(records(spark, sf_dir))


PANEL_SQL = f"SELECT *, {MEASURES_SQL} FROM ({RECORDS_SQL}) r"

# Lines whose shipping can be studied: each step's name and its condition for the oracle.
ELIGIBILITY_RULES_SQL = [
    ("not shipped before its order", "l_shipdate >= o_orderdate"),
    ("known return flag", "l_returnflag IN ('A', 'N', 'R')"),
    ("charge is a positive number", "isfinite(charge) AND charge > 0"),
    ("discount below the whole price", "l_discount < 1"),
    ("whole parcels, one to twelve", "parcels BETWEEN 1 AND 12 AND parcels = floor(parcels)"),
    ("a unit or more in each parcel", "parcels <= l_quantity"),
    ("line still open", "l_linestatus = 'O'"),
]


def eligibility_rules() -> list[Rule]:
    """The same steps as columns (these need an active session, hence a function)."""
    conditions = [
        F.col("l_shipdate") >= F.col("o_orderdate"),
        F.col("l_returnflag").isin(*RETURNFLAG_LABELS),
        is_finite("charge") & (F.col("charge") > 0),
        F.col("l_discount") < 1,
        is_integer_between("parcels", 1, 12),
        F.col("parcels") <= F.col("l_quantity"),
        F.col("l_linestatus") == "O",
    ]
    return [Rule(name, condition) for (name, _), condition in zip(ELIGIBILITY_RULES_SQL, conditions, strict=True)]


def eligible_where_sql() -> str:
    return " AND ".join(f"COALESCE(({c}), FALSE)" for _, c in ELIGIBILITY_RULES_SQL)


def label_sql(column: str, labels: dict[str, str], unknown_code: str, unknown_label: str) -> tuple[str, str]:
    keys = ", ".join(f"'{k}'" for k in labels)
    code = f"CASE WHEN {column} IN ({keys}) THEN {column} ELSE '{unknown_code}' END"
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    label = f"CASE {column} {whens} ELSE '{unknown_label}' END"
    return code, label


# ---- period files -------------------------------------------------------------

def period_files(expected: dict[int, int] | None = None) -> list[Listing]:
    expected = EXPECTED_ROWS_SF001 if expected is None else expected
    return [Listing(f"lineitem_{y}", {"period": str(y), "year": y}, expected.get(y)) for y in YEARS]


def year_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows shipped in years ``first..last`` as a range predicate on the raw
    timestamp, so it reaches the Parquet scan (row groups outside the range
    are skipped)."""
    lo = F.make_timestamp_ntz(F.lit(first), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    hi = F.make_timestamp_ntz(F.lit(last + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return df.where((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi))


def year_slice(df: DataFrame, year: int) -> DataFrame:
    return year_range(df, year, year)


def outside_years(df: DataFrame) -> DataFrame:
    """Rows of no listed year: shipped earlier or later, or without a date."""
    year = F.year("l_shipdate")
    return df.where(year.isNull() | ~year.isin(*YEARS))


def period_frames(spark: SparkSession, sf_dir: str, columns: list[str]) -> dict[str, DataFrame]:
    """One frame per yearly "file", and one of the rows outside all years; each
    lists the columns in another order (rotated), as period files do."""
    li = table(spark, sf_dir, "lineitem")
    frames = {}
    for i, y in enumerate((*YEARS, None)):
        rot = i % len(columns)
        order = columns[rot:] + columns[:rot]
        rows = outside_years(li) if y is None else year_slice(li, y)
        frames[OTHER if y is None else str(y)] = rows.select(*order)
    return frames


# ---- fixtures with a known answer ----------------------------------------------

def linear_target() -> Column:
    flag = (F.when(F.col("l_returnflag") == "R", F.lit(500))
            .when(F.col("l_returnflag") == "A", F.lit(250)).otherwise(F.lit(0)))
    return (F.lit(1000) + F.lit(35) * F.col("l_quantity") - F.lit(4000) * F.col("l_discount")
            + F.lit(2000) * F.col("l_tax") + flag).cast("double")


LINEAR_SQL = ("CAST(1000 + 35 * l_quantity - 4000 * l_discount + 2000 * l_tax + "
              "CASE WHEN l_returnflag = 'R' THEN 500 WHEN l_returnflag = 'A' THEN 250 ELSE 0 END "
              "AS DOUBLE)")


def step_target() -> Column:
    flag = (F.when(F.col("l_returnflag") == "R", F.lit(500))
            .when(F.col("l_returnflag") == "A", F.lit(250)).otherwise(F.lit(0)))
    status = F.when(F.col("l_linestatus") == "F", F.lit(10)).otherwise(F.lit(0))
    return (flag + status).cast("double")


STEP_SQL = ("CAST(CASE WHEN l_returnflag = 'R' THEN 500 WHEN l_returnflag = 'A' THEN 250 ELSE 0 END "
            "+ CASE WHEN l_linestatus = 'F' THEN 10 ELSE 0 END AS DOUBLE)")


def separable_features() -> dict[str, Column]:
    """Two tight, far-apart blobs (one per line status) on both axes, so
    k = 2 has one optimum whatever the initialisation."""
    is_f = F.col("l_linestatus") == "F"
    a = F.col("l_quantity") / F.lit(50) + F.when(is_f, F.lit(100)).otherwise(F.lit(0))
    b = F.col("l_tax") + F.when(is_f, F.lit(10)).otherwise(F.lit(0))
    return {"sep_a": a, "sep_b": b}


SEPARABLE_CLUSTER_SQL = "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END"


def rule_prediction_a() -> Column:
    return (F.lit(1500.0) * F.col("l_quantity")).cast("double")


def rule_prediction_b() -> Column:
    return (F.lit(1000.0) * F.col("l_quantity") + F.lit(20000.0)).cast("double")


PRED_A_SQL = "CAST(1500.0 * l_quantity AS DOUBLE)"
PRED_B_SQL = "CAST(1000.0 * l_quantity + 20000.0 AS DOUBLE)"
