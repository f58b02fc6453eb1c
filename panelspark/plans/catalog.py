"""Registered queries over the driver tables, and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` built from the library
operators on the stand-in frames of ``standin``; each oracle is an
independent SQL statement over the pre-registered views.  Floating results
are rounded to the same number of decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.columns import (
    UNKNOWN_CODE, UNKNOWN_LABEL, clean_code_text, fingerprint, is_finite, to_double)
from panelspark.operators import audit, diagnose, funnel, labels, quantiles, regress, segment, stats
from panelspark.operators.harmonise import harmonise, tenure
from panelspark.operators.union import union_periods
from panelspark.plans import standin as S
from panelspark.session import shared_dir
from panelspark.sources import manifest as M
from panelspark.sources import scan, store

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def r4(c):
    return F.round(c, 4)


def r6(c):
    return F.round(c, 6)


KEY3 = ["l_orderkey", "l_linenumber", "l_partkey"]
KEY3_SQL = "l_orderkey, l_linenumber, l_partkey"
PCT_SQL = ("('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), "
           "CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), '42')), 1, 7))::BIGINT % 100")
ELIGIBLE_SQL = f"SELECT * FROM ({S.PANEL_SQL}) p WHERE {S.eligible_where_sql()}"
PRIO_CODE_SQL, PRIO_LABEL_SQL = S.label_sql("priority_code", S.PRIORITY_LABELS, UNKNOWN_CODE, UNKNOWN_LABEL)
FLAG_CODE_SQL, FLAG_LABEL_SQL = S.label_sql("l_returnflag", S.RETURNFLAG_LABELS, UNKNOWN_CODE, UNKNOWN_LABEL)
STATUS_CODE_SQL, STATUS_LABEL_SQL = S.label_sql("l_linestatus", S.LINESTATUS_LABELS, UNKNOWN_CODE, UNKNOWN_LABEL)
LABELLED_ELIGIBLE_SQL = (f"SELECT *, {FLAG_CODE_SQL} AS flag_code, {FLAG_LABEL_SQL} AS flag_label, "
                         f"{PRIO_CODE_SQL} AS prio_code, {PRIO_LABEL_SQL} AS prio_label "
                         f"FROM ({ELIGIBLE_SQL}) e")
DICTS = {"l_returnflag": S.RETURNFLAG_LABELS, "priority_code": S.PRIORITY_LABELS}


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel-filtered and labelled records (the reference's eligible set)."""
    rows = funnel.apply_rules(S.panel(spark, sf_dir), S.eligibility_rules())
    return labels.label_codes(rows, DICTS)


# ============================================================================
# Sources
# ============================================================================

SCAN_MAP = {"order_key": "l_orderkey", "line_number": "l_linenumber", "part_key": "l_partkey",
            "quantity": "l_quantity", "price": "l_extendedprice", "flag": "l_returnflag"}


@query("scan_by_name", sql="SELECT l_orderkey AS order_key, l_linenumber AS line_number, "
       "l_partkey AS part_key, l_quantity AS quantity, l_extendedprice AS price, "
       "l_returnflag AS flag FROM lineitem")
def q_scan_by_name(spark, sf_dir):
    return scan.scan_by_name(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", SCAN_MAP)


UNION_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
YEARS_SQL = ", ".join(str(y) for y in S.YEARS)
PERIOD_SQL = f"CASE WHEN year(l_shipdate) IN ({YEARS_SQL}) THEN CAST(year(l_shipdate) AS VARCHAR) ELSE '{S.OTHER}' END"
LISTED_YEAR_SQL = f"CAST(CASE WHEN year(l_shipdate) IN ({YEARS_SQL}) THEN year(l_shipdate) END AS INTEGER)"


def _union(spark, sf_dir):
    files = S.period_files()
    frames = S.period_frames(spark, sf_dir, UNION_COLUMNS)
    prov = {f.period: f.provenance() for f in files}
    prov[S.OTHER] = {"source_file": f"lineitem_{S.OTHER}", "period": S.OTHER, "year": None}
    return union_periods(frames, prov, columns=UNION_COLUMNS)


@query("union_periods", sql=f"SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
       f"l_returnflag, 'lineitem_' || {PERIOD_SQL} AS source_file, "
       f"{PERIOD_SQL} AS period, {LISTED_YEAR_SQL} AS year FROM lineitem")
def q_union_periods(spark, sf_dir):
    return _union(spark, sf_dir)


def _manifest_values_sql() -> str:
    rows = ", ".join(f"('{f.period}', '{f.file_name}', CAST({f.rows} AS BIGINT))"
                     for f in S.period_files())
    return f"(VALUES {rows}) m(period, file_name, expected_rows)"


#: Bytes of landed files in one micro-batch, which its tasks share.
STREAM_BATCH_BYTES = 512 << 20


@query("stream_ingest_periods", sql=(
    f"SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
    f"l_returnflag, 'lineitem_' || {PERIOD_SQL} AS source_file, "
    f"NULLIF({PERIOD_SQL}, '{S.OTHER}') AS period, {LISTED_YEAR_SQL} AS year FROM lineitem"))
def q_stream_ingest_periods(spark, sf_dir):
    """The yearly slices land as one folder per period file; a file-source
    stream ingests whatever has landed (exactly once, checkpointed) into the
    period-partitioned dataset, which is then read back.  Rows outside the listed
    years land in a folder that the manifest does not list: their period is NULL."""
    from pyspark.sql import types as T
    from panelspark.streaming.ingest import ingest_available, period_stream
    landing = shared_dir(spark, "landing", unique=True)
    li = S.table(spark, sf_dir, "lineitem")
    # A write for each period: split by a column in one write, a task would sort all its rows.
    for period, rows in S.period_frames(spark, sf_dir, UNION_COLUMNS).items():
        store.write_parquet(rows, f"{landing}/source_file=lineitem_{period}")
    schema = T.StructType([*[li.schema[c] for c in UNION_COLUMNS],
                           T.StructField("source_file", T.StringType())])
    man = M.manifest_frame(spark, S.period_files())
    stream = period_stream(spark, landing, {c: c for c in UNION_COLUMNS}, man, schema=schema,
                           source_col="source_file", max_bytes_per_trigger=STREAM_BATCH_BYTES)
    out = shared_dir(spark, "ingested", unique=True)
    ingest_available(stream, out, shared_dir(spark, "ingest-checkpoint", unique=True))
    # Partition discovery reads the period directories back as numbers.
    return spark.read.parquet(out).select(*UNION_COLUMNS, "source_file", F.col("period").cast("string"),
                                          F.col("year").cast("int"))


CSV_MAP = {"order_key": "l_orderkey", "line_number": "l_linenumber", "quantity": "l_quantity",
           "price": "l_extendedprice", "flag": "l_returnflag"}


@query("csv_scan_periods", sql=(
    f"SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line_number, "
    f"l_quantity AS quantity, l_extendedprice AS price, l_returnflag AS flag, "
    f"CASE WHEN coalesce(year(l_shipdate) >= {S.HOLDOUT_YEAR}, FALSE) THEN 'holdout' ELSE 'development' END AS period, "
    f"CASE WHEN coalesce(year(l_shipdate) >= {S.HOLDOUT_YEAR}, FALSE) THEN 'lineitem_holdout.csv' "
    f"ELSE 'lineitem_development.csv' END AS source_file FROM lineitem"))
def q_csv_scan_periods(spark, sf_dir):
    """Period files as the reference receives them: delimited text with a
    header, columns in a different order per file.  Each lands as CSV in the
    shared folder, is scanned by header name (never by position), typed
    (text -> double with ``try_cast``; codes trimmed) and stacked by name."""
    landing = shared_dir(spark, "csv-landing", unique=True)
    dev, hold = _dev_holdout(spark, sf_dir)
    cols = list(CSV_MAP.values())
    files = [M.Listing("lineitem_development.csv", {"period": "development"}),
             M.Listing("lineitem_holdout.csv", {"period": "holdout"})]
    for frame, f, order in ((dev, files[0], cols), (hold, files[1], cols[::-1])):
        store.write_csv(frame.select(*order), f"{landing}/{f.file_name}")
    data = scan.scan_periods(spark, landing, files, CSV_MAP, fmt="csv")
    typed = harmonise(data, measures=["quantity", "price"], codes=["order_key", "line_number", "flag"])
    return typed.select(*CSV_MAP, "period", "source_file")


def _audit_columns(year: int) -> list[str]:
    """The columns of a year's landed file: rotated, and one more from the middle year on."""
    at = S.YEARS.index(year)
    turned = UNION_COLUMNS[at % len(UNION_COLUMNS):] + UNION_COLUMNS[:at % len(UNION_COLUMNS)]
    return turned + (["l_tax"] if 2 * at >= len(S.YEARS) else [])


_WIDTHS_SQL = "(VALUES " + ", ".join(f"('{y}', CAST({len(_audit_columns(y))} AS INTEGER))" for y in S.YEARS) + ") w(period, columns)"


@query("manifest_row_audit", sql=(
    f"WITH l AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS p, count(*) AS n FROM lineitem GROUP BY 1), "
    f"a AS (SELECT coalesce(m.period, l.p) AS period, m.file_name, m.expected_rows, coalesce(l.n, 0) AS rows, "
    f"CASE WHEN m.period IS NULL THEN 'unlisted' WHEN coalesce(l.n, 0) = m.expected_rows THEN 'matched' "
    f"WHEN l.n IS NULL THEN 'missing' ELSE 'differs' END AS status "
    f"FROM {_manifest_values_sql()} FULL JOIN l ON m.period IS NOT DISTINCT FROM l.p) "
    f"SELECT a.*, status = 'matched' AS ok, w.columns FROM a LEFT JOIN {_WIDTHS_SQL} ON w.period = a.period"))
def q_manifest_row_audit(spark, sf_dir):
    """Rows per period against the manifest, every row of the table accounted
    for (periods outside the manifest and rows without a date too), and the
    columns that each landed period file lists in its own header."""
    files = S.period_files()
    landing = shared_dir(spark, "audit-landing", unique=True)
    li = S.table(spark, sf_dir, "lineitem")
    for f in files:
        store.write_csv(S.year_slice(li, f.attributes["year"]).select(*_audit_columns(f.attributes["year"])), f"{landing}/{f.file_name}")
    widths = scan.column_counts(spark, landing, files)
    audit_df = M.row_audit(S.lines(spark, sf_dir).select("period"), M.manifest_frame(spark, files), widths)
    return audit_df.select("period", "file_name", "expected_rows", "rows", "status", "ok", "columns")


@query("parquet_roundtrip", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
       "o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def q_parquet_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "roundtrip", unique=True)
    orders = S.table(spark, sf_dir, "orders")

    def build():
        return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                             "o_orderpriority", F.year("o_orderdate").alias("order_year"))
    back = store.read_or_build(spark, path, build, partition_by=["order_year"])
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       "o_orderpriority", F.col("order_year").cast("int"))


# ============================================================================
# Cleaning
# ============================================================================

@query("clean_text_codes", sql=(
    f"SELECT l_orderkey, l_linenumber, dirty AS raw, "
    f"regexp_replace(NULLIF(trim(dirty), ''), '^(-?[0-9]+)\\.0+$', '\\1') AS code "
    f"FROM ({S.LINES_SQL}) t"))
def q_clean_text_codes(spark, sf_dir):
    li = S.lines(spark, sf_dir)
    return li.select("l_orderkey", "l_linenumber", F.col("dirty").alias("raw"),
                     clean_code_text("dirty").alias("code"))


@query("clean_numeric_measures", sql=(
    f"SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(v) THEN v END AS value, "
    f"CASE WHEN v IS NULL THEN 'missing' WHEN NOT isfinite(v) THEN 'non_finite' ELSE 'finite' END AS state "
    f"FROM (SELECT *, TRY_CAST(dirty AS DOUBLE) AS v FROM ({S.LINES_SQL}) t) u"))
def q_clean_numeric_measures(spark, sf_dir):
    typed = harmonise(S.lines(spark, sf_dir), measures=["dirty"])
    v = F.col("dirty")
    state = (F.when(v.isNull(), F.lit("missing"))
             .when(~is_finite(v), F.lit("non_finite")).otherwise(F.lit("finite")))
    return typed.select("l_orderkey", "l_linenumber",
                        F.when(is_finite(v), v).alias("value"), state.alias("state"))


@query("derive_tenure", sql=(
    f"SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(t) THEN round(t, 6) END AS tenure "
    f"FROM (SELECT *, l_discount * 100 + TRY_CAST(dirty AS DOUBLE) / 12.0 AS t "
    f"FROM ({S.LINES_SQL}) a) b"))
def q_derive_tenure(spark, sf_dir):
    li = S.lines(spark, sf_dir).withColumns({"years": F.col("l_discount") * F.lit(100),
                                             "months": to_double("dirty")})
    t = tenure("years", "months")
    return li.select("l_orderkey", "l_linenumber", F.when(is_finite(t), r6(t)).alias("tenure"))


# ============================================================================
# Audits
# ============================================================================

@query("source_code_crosstab", sql=(
    f"SELECT period, ship_quarter, count(*) AS n FROM ({S.LINES_SQL}) t GROUP BY period, ship_quarter"))
def q_source_code_crosstab(spark, sf_dir):
    return audit.crosstab_counts(S.lines(spark, sf_dir), ["period", "ship_quarter"])


MISSING_COLUMNS = ["dirty", "code", "l_quantity", "l_returnflag"]


def _missing_sql() -> str:
    parts = []
    for c in MISSING_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') "
            f"AS missing, round(CAST(count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') "
            f"AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE), 6) AS pct FROM m")
    body = " UNION ALL ".join(parts)
    return (f"WITH m AS (SELECT *, regexp_replace(NULLIF(trim(dirty), ''), '^(-?[0-9]+)\\.0+$', '\\1') "
            f"AS code FROM ({S.LINES_SQL}) t) {body}")


@query("missing_audit", sql=_missing_sql())
def q_missing_audit(spark, sf_dir):
    li = S.lines(spark, sf_dir).withColumn("code", clean_code_text("dirty"))
    out = audit.missing_audit(li, MISSING_COLUMNS)
    return out.withColumn("pct", r6("pct"))


def _eligible_cols(df):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "period", "l_extendedprice",
                     "l_quantity", "parcels", r6("charge").alias("charge"), "days_to_ship",
                     "l_returnflag", "l_returnflag_label", "priority_code", "priority_code_label")


@query("eligible_rows", sql=(
    f"SELECT l_orderkey, l_linenumber, l_partkey, period, l_extendedprice, l_quantity, parcels, "
    f"round(charge, 6) AS charge, days_to_ship, flag_code AS l_returnflag, "
    f"flag_label AS l_returnflag_label, prio_code AS priority_code, prio_label AS priority_code_label "
    f"FROM ({LABELLED_ELIGIBLE_SQL}) x"))
def q_eligible_rows(spark, sf_dir):
    return _eligible_cols(eligible(spark, sf_dir))


def _funnel_sql() -> str:
    conds = [c for _, c in S.ELIGIBILITY_RULES_SQL]
    aggs = ["count(*) AS n0"]
    for i in range(1, len(conds) + 1):
        prefix = " AND ".join(f"COALESCE(({c}), FALSE)" for c in conds[:i])
        aggs.append(f"count(*) FILTER (WHERE {prefix}) AS n{i}")
    rows = [f"SELECT 0 AS step_no, '{funnel.BASE_STEP}' AS step, n0 AS remaining, "
            f"CAST(0 AS BIGINT) AS excluded FROM c"]
    for i, (name, _) in enumerate(S.ELIGIBILITY_RULES_SQL, start=1):
        rows.append(f"SELECT {i}, '{name}', n{i}, n{i - 1} - n{i} FROM c")
    return f"WITH c AS (SELECT {', '.join(aggs)} FROM ({S.PANEL_SQL}) p) " + " UNION ALL ".join(rows)


@query("eligibility_funnel", sql=_funnel_sql())
def q_eligibility_funnel(spark, sf_dir):
    return funnel.funnel(S.panel(spark, sf_dir), S.eligibility_rules())


@query("label_categories", sql=(
    f"SELECT l_orderkey, l_linenumber, {FLAG_CODE_SQL} AS l_returnflag, {FLAG_LABEL_SQL} AS l_returnflag_label, "
    f"{STATUS_CODE_SQL} AS l_linestatus, {STATUS_LABEL_SQL} AS l_linestatus_label, "
    f"{PRIO_CODE_SQL} AS priority_code, {PRIO_LABEL_SQL} AS priority_code_label "
    f"FROM ({S.RECORDS_SQL}) r"))
def q_label_categories(spark, sf_dir):
    rec = S.records(spark, sf_dir)
    out = labels.label_codes(rec, {"l_returnflag": S.RETURNFLAG_LABELS,
                                   "l_linestatus": S.LINESTATUS_LABELS,
                                   "priority_code": S.PRIORITY_LABELS})
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_returnflag_label",
                      "l_linestatus", "l_linestatus_label", "priority_code", "priority_code_label")


@query("duplicate_keys", sql="SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
       "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def q_duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(S.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


FP_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _fp_sql() -> str:
    parts = [f"COALESCE(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), "
             f"'<NULL>')" for c in FP_COLUMNS]
    return f"SELECT o_orderkey, sha256(concat_ws('§', {', '.join(parts)})) AS fingerprint FROM orders"


@query("row_fingerprint", sql=_fp_sql())
def q_row_fingerprint(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fingerprint(FP_COLUMNS).alias("fingerprint"))


def _double_landed(spark, sf_dir):
    """lineitem plus the holdout year's file loaded a second time (a period
    file landed twice: its keys repeat as exact copies)."""
    li = S.table(spark, sf_dir, "lineitem")
    return li.unionByName(S.year_slice(li, S.HOLDOUT_YEAR))


DOUBLE_LANDED_SQL = (f"SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem "
                     f"WHERE year(l_shipdate) = {S.HOLDOUT_YEAR}")
VERSIONS_SQL = (f"SELECT l_orderkey, l_linenumber, count(*) AS n, "
                f"count(DISTINCT ({', '.join(S.LINEITEM_COLUMNS)})) AS versions "
                f"FROM ({DOUBLE_LANDED_SQL}) u GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")


@query("duplicate_versions", sql=VERSIONS_SQL)
def q_duplicate_versions(spark, sf_dir):
    return audit.duplicate_versions(_double_landed(spark, sf_dir), ["l_orderkey", "l_linenumber"],
                                    S.LINEITEM_COLUMNS)


@query("duplicate_version_histogram",
       sql=f"SELECT versions, count(*) AS keys FROM ({VERSIONS_SQL}) v GROUP BY versions")
def q_duplicate_version_histogram(spark, sf_dir):
    return audit.version_histogram(q_duplicate_versions(spark, sf_dir))


# ============================================================================
# Statistics
# ============================================================================

SUMMARY_COLUMNS = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def _summary_sql() -> str:
    parts = []
    for c in SUMMARY_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, "
            f"quantile_disc({c}, 0.5) AS median, round(stddev_samp({c}), 4) AS stddev, "
            f"min({c}) AS min, quantile_disc({c}, 0.25) AS p25, quantile_disc({c}, 0.75) AS p75, "
            f"quantile_disc({c}, 0.95) AS p95, max({c}) AS max FROM lineitem")
    return " UNION ALL ".join(parts)


@query("numeric_summary", sql=_summary_sql())
def q_numeric_summary(spark, sf_dir):
    out = stats.numeric_summary(S.table(spark, sf_dir, "lineitem"), SUMMARY_COLUMNS)
    return out.withColumns({"mean": r4("mean"), "stddev": r4("stddev")})


VALUE_PROBS = [0.25, 0.5, 0.75, 0.9, 0.95]


@query("value_quantiles", sql=" UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS prob, quantile_disc(o_totalprice, {p}) AS value FROM orders"
    for p in VALUE_PROBS))
def q_value_quantiles(spark, sf_dir):
    return quantiles.exact_quantiles(S.table(spark, sf_dir, "orders"), "o_totalprice", VALUE_PROBS,
                                     out_col="value")


GROUP_MEDIAN_SQL = (
    f"SELECT prio_code AS priority_code, prio_label AS priority_code_label, count(*) AS n, "
    f"quantile_disc(l_extendedprice, 0.5) AS median_price FROM ({LABELLED_ELIGIBLE_SQL}) x "
    f"GROUP BY prio_code, prio_label")


def group_median_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: scan -> derive/clean -> eligibility funnel -> labels ->
    median price by priority code, highest first."""
    rows = eligible(spark, sf_dir)
    return stats.group_median(rows, "l_extendedprice", ["priority_code", "priority_code_label"],
                              group_bound=len(S.PRIORITY_LABELS) + 1, median_col="median_price")


@query("group_median", sql=GROUP_MEDIAN_SQL)
def q_group_median(spark, sf_dir):
    return group_median_plan(spark, sf_dir)


@query("group_median_approx")
def q_group_median_approx(spark, sf_dir):
    """The flagship with the Greenwald-Khanna sketch (``percentile_approx``,
    accuracy 10000): bounded memory per group, one partial aggregation.  An
    approximate answer, so no exact oracle; the tests bound its rank error."""
    rows = eligible(spark, sf_dir)
    return stats.group_median(rows, "l_extendedprice", ["priority_code", "priority_code_label"],
                              method="approx", accuracy=10000, median_col="median_price")


@query("period_median", sql=(
    f"SELECT period, count(*) AS n, quantile_disc(l_extendedprice, 0.5) AS median_price "
    f"FROM ({S.LINES_SQL}) t GROUP BY period"))
def q_period_median(spark, sf_dir):
    return stats.group_median(S.lines(spark, sf_dir), "l_extendedprice", ["period"],
                              median_col="median_price")


@query("category_frequency", sql=(
    f"SELECT 'l_returnflag_label' AS variable, flag_label AS value, count(*) AS n "
    f"FROM ({LABELLED_ELIGIBLE_SQL}) x GROUP BY flag_label UNION ALL "
    f"SELECT 'priority_code_label', prio_label, count(*) FROM ({LABELLED_ELIGIBLE_SQL}) x GROUP BY prio_label "
    f"UNION ALL SELECT 'period', period, count(*) FROM ({LABELLED_ELIGIBLE_SQL}) x GROUP BY period"))
def q_category_frequency(spark, sf_dir):
    return stats.category_frequency(eligible(spark, sf_dir),
                                    ["l_returnflag_label", "priority_code_label", "period"])


def _sample_sql(n: int, cols: str, extra_order: str) -> str:
    keys = ", ".join(f"CAST({c} AS VARCHAR)" for c in S.SAMPLE_KEY)
    return (f"SELECT {cols} FROM lineitem ORDER BY md5(concat_ws('|', {keys}, '42')), "
            f"{', '.join(S.SAMPLE_KEY)}, {extra_order} LIMIT {n}")


@query("seeded_sample", sql=_sample_sql(10000, "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice",
                                        "l_extendedprice"))
def q_seeded_sample(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return stats.seeded_sample(li, 10000, S.SAMPLE_KEY, columns=S.SAMPLE_KEY + ["l_extendedprice"])


def _hist_sql(expr: str, bins: int = 60) -> str:
    return (f"WITH a AS (SELECT {expr} AS x FROM orders), b AS (SELECT CASE WHEN isfinite(x) THEN x END AS x FROM a), "
            f"s AS (SELECT min(x) AS lo, max(x) AS hi FROM b), "
            f"h AS (SELECT CASE WHEN x IS NULL THEN NULL WHEN hi = lo THEN 0 ELSE CAST(LEAST(floor((x - lo) * {bins} / (hi - lo)), "
            f"{bins - 1}) AS INTEGER) END AS bin FROM b, s) "
            f"SELECT bin, round(lo + bin * (hi - lo) / {bins}, 6) AS lo, "
            f"round(lo + (bin + 1) * (hi - lo) / {bins}, 6) AS hi, count(*) AS n FROM h, s "
            f"GROUP BY bin, s.lo, s.hi")


@query("histogram", sql=_hist_sql("o_totalprice"))
def q_histogram(spark, sf_dir):
    h = stats.histogram(S.table(spark, sf_dir, "orders"), "o_totalprice", 60)
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi")})


@query("log_histogram", sql=_hist_sql("CASE WHEN o_totalprice > 0 THEN log10(o_totalprice) END"))
def q_log_histogram(spark, sf_dir):
    h = stats.histogram(S.table(spark, sf_dir, "orders"), "o_totalprice", 60, log10=True)
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi")})


CORR_COLUMNS = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query("correlation_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for a in CORR_COLUMNS for b in CORR_COLUMNS))
def q_correlation_matrix(spark, sf_dir):
    out = stats.correlation_long(S.table(spark, sf_dir, "lineitem"), CORR_COLUMNS)
    return out.withColumn("r", r6("r"))


@query("top_association", sql=(
    "SELECT variable, round(r, 6) AS r, round(abs(r), 6) AS abs_r FROM ("
    + " UNION ALL ".join(f"SELECT '{b}' AS variable, corr(l_extendedprice, {b}) AS r FROM lineitem"
                         for b in CORR_COLUMNS[1:])
    + ") c ORDER BY abs(r) DESC, variable LIMIT 1"))
def q_top_association(spark, sf_dir):
    corr = stats.correlation_long(S.table(spark, sf_dir, "lineitem"), CORR_COLUMNS)
    top = stats.top_association(corr, "l_extendedprice")
    return top.select("variable", r6("r").alias("r"), r6("abs_r").alias("abs_r"))


STD_COLUMNS = ["l_quantity", "l_discount", "l_tax"]


@query("standardized_features", sql=(
    f"SELECT {KEY3_SQL}, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 4) AS z_{c}" for c in STD_COLUMNS)
    + " FROM lineitem"))
def q_standardized_features(spark, sf_dir):
    out = segment.standardized_columns(S.table(spark, sf_dir, "lineitem"), STD_COLUMNS, keep=KEY3)
    # 4 decimals: 3 values per row, and the mean/std sums may round in another
    # order under another partitioning.
    return out.select(*KEY3, *[r4(f"z_{c}").alias(f"z_{c}") for c in STD_COLUMNS])


# ============================================================================
# Segmentation
# ============================================================================

@query("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    table, _ = segment.scaled_sweep(S.table(spark, sf_dir, "lineitem"), STD_COLUMNS, ks=(2, 3, 4, 5), seed=42, keys=KEY3)
    return table.select("k", r6("silhouette").alias("silhouette"), r4("wssse").alias("wssse"), "chosen")


def _separable(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem").withColumns(S.separable_features())
    _, scored = segment.fit_segments(li, ["sep_a", "sep_b"], k=2, seed=42, keys=KEY3)
    return scored


@query("kmeans_assign", sql=f"SELECT {KEY3_SQL}, {S.SEPARABLE_CLUSTER_SQL} AS cluster FROM lineitem")
def q_kmeans_assign(spark, sf_dir):
    return _separable(spark, sf_dir).select(*KEY3, "cluster")


def _silhouette_sql(cluster: str, x1: str, x2: str) -> str:
    # Closed form of the squared-Euclidean silhouette: per point the mean
    # squared distance to cluster C is |x|^2 - 2 x.s_C / n_C + Y_C / n_C;
    # for the point's own cluster it is rescaled by n / (n - 1).
    return (
        f"WITH p AS (SELECT row_number() OVER () AS pid, {cluster} AS c, "
        f"{x1} AS x1, {x2} AS x2 FROM lineitem), "
        "k AS (SELECT c, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x1 * x1 + x2 * x2) AS y "
        "FROM p GROUP BY c), "
        "d AS (SELECT p.pid, p.c AS own, k.c AS other, k.n AS n, "
        "(p.x1 * p.x1 + p.x2 * p.x2) - 2 * (p.x1 * k.s1 + p.x2 * k.s2) / k.n + k.y / k.n AS dist "
        "FROM p, k), "
        "a AS (SELECT pid, max(CASE WHEN other = own THEN CASE WHEN n > 1 THEN dist * n / (n - 1) "
        "ELSE 0 END END) AS a, min(CASE WHEN other <> own THEN dist END) AS b, "
        "max(CASE WHEN other = own THEN n END) AS nown FROM d GROUP BY pid), "
        "s AS (SELECT CASE WHEN nown = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 "
        "ELSE 0 END AS s FROM a) "
        "SELECT round(avg(s), 6) AS silhouette FROM s")


@query("silhouette_score", sql=_silhouette_sql("CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END", "l_quantity", "l_discount * 100"))
def q_silhouette_score(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    li = S.table(spark, sf_dir, "lineitem").withColumns({
        "cluster": F.when(F.col("l_quantity") > 25, F.lit(1)).otherwise(F.lit(0)),
        "x2": F.col("l_discount") * F.lit(100)})
    feats = VectorAssembler(inputCols=["l_quantity", "x2"], outputCol="features").transform(li)
    value = segment.silhouette(feats, "features", "cluster")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


# Three separated groups by return flag: two near ones and a far one.  Two
# clusters join the near ones, three clusters are the groups themselves.
BLOB_SQL = "l_discount + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 10 ELSE 60 END"
BLOB_CLUSTERS = {2: "CASE WHEN l_returnflag IN ('A', 'N') THEN 0 ELSE 1 END",
                 3: "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"}


def _cost_sql(cluster: str) -> str:
    return (f"SELECT round(sum(c), 4) AS wssse FROM (SELECT var_pop({BLOB_SQL}) * count(*) + var_pop(l_tax) * count(*) AS c "
            f"FROM lineitem GROUP BY {cluster}) g")


@query("kmeans_sweep_separated", sql=(
    "SELECT k, silhouette, wssse, row_number() OVER (ORDER BY silhouette DESC, k) = 1 AS chosen FROM ("
    + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS k, ({_silhouette_sql(c, BLOB_SQL, 'l_tax')}) AS silhouette, "
                         f"({_cost_sql(c)}) AS wssse" for k, c in BLOB_CLUSTERS.items()) + ") t"))
def q_kmeans_sweep_separated(spark, sf_dir):
    """The sweep over groups with a known answer: costs, silhouettes and the choice."""
    from pyspark.ml.feature import VectorAssembler
    li = S.table(spark, sf_dir, "lineitem").withColumn("x", F.expr(BLOB_SQL))
    feats = VectorAssembler(inputCols=["x", "l_tax"], outputCol="features").transform(li)
    table, _ = segment.kmeans_sweep(feats, "features", ks=tuple(BLOB_CLUSTERS), keys=KEY3)
    return table.select("k", r6("silhouette").alias("silhouette"), r4("wssse").alias("wssse"), "chosen")


PROFILE_MODES = {"l_returnflag": "returnflag_mode", "l_linestatus": "linestatus_mode"}


def _profile(spark, sf_dir):
    scored = _separable(spark, sf_dir)
    prof = segment.cluster_profile(scored, "cluster", ["l_quantity", "l_tax"], "l_extendedprice",
                                   PROFILE_MODES, cluster_bound=2)
    return scored, prof


def _mode_sql(col: str, out: str) -> str:
    return (f"(SELECT cluster, {col} AS {out} FROM (SELECT cluster, {col}, row_number() OVER "
            f"(PARTITION BY cluster ORDER BY count(*) DESC, {col} ASC) AS rn FROM sep "
            f"GROUP BY cluster, {col}) z WHERE rn = 1)")


SEP_SQL = f"SELECT *, {S.SEPARABLE_CLUSTER_SQL} AS cluster FROM lineitem"
PROFILE_SQL = (
    f"WITH sep AS ({SEP_SQL}), num AS (SELECT cluster, count(*) AS n, round(avg(l_quantity), 4) AS l_quantity_mean, "
    f"round(avg(l_tax), 6) AS l_tax_mean, quantile_disc(l_extendedprice, 0.5) AS l_extendedprice_median "
    f"FROM sep GROUP BY cluster) "
    f"SELECT num.*, m1.returnflag_mode, m2.linestatus_mode FROM num "
    f"JOIN {_mode_sql('l_returnflag', 'returnflag_mode')} m1 USING (cluster) "
    f"JOIN {_mode_sql('l_linestatus', 'linestatus_mode')} m2 USING (cluster)")


@query("cluster_profile", sql=PROFILE_SQL)
def q_cluster_profile(spark, sf_dir):
    _, prof = _profile(spark, sf_dir)
    return prof.select("cluster", "n", r4("l_quantity_mean").alias("l_quantity_mean"),
                       r6("l_tax_mean").alias("l_tax_mean"), "l_extendedprice_median",
                       "returnflag_mode", "linestatus_mode")


@query("cluster_mode", sql=f"WITH sep AS ({SEP_SQL}) SELECT * FROM {_mode_sql('l_returnflag', 'returnflag_mode')} m")
def q_cluster_mode(spark, sf_dir):
    return stats.group_mode(_separable(spark, sf_dir), ["cluster"], "l_returnflag", "returnflag_mode")


@query("cluster_description", sql=(
    f"WITH sep AS ({SEP_SQL}), g AS (SELECT avg(l_quantity) AS q, avg(l_tax) AS t FROM sep), "
    f"num AS (SELECT cluster, avg(l_quantity) AS qm, avg(l_tax) AS tm FROM sep GROUP BY cluster) "
    f"SELECT num.cluster, (CASE WHEN qm >= q THEN 'higher' ELSE 'lower' END) || ' quantity, ' || "
    f"(CASE WHEN tm >= t THEN 'higher' ELSE 'lower' END) || ' tax; mostly ' || lower(m.returnflag_mode) "
    f"AS description FROM num, g, {_mode_sql('l_returnflag', 'returnflag_mode')} m WHERE m.cluster = num.cluster"))
def q_cluster_description(spark, sf_dir):
    scored, prof = _profile(spark, sf_dir)
    desc = segment.describe_clusters(prof, scored, ["l_quantity", "l_tax"], "returnflag_mode",
                                     names={"l_quantity": "quantity", "l_tax": "tax"})
    return desc.select("cluster", "description")


# ============================================================================
# Regression
# ============================================================================

@query("train_validation_split", sql=(
    f"SELECT {KEY3_SQL}, CASE WHEN {PCT_SQL} < 80 THEN 'train' ELSE 'validation' END AS split FROM lineitem"))
def q_train_validation_split(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return regress.hash_split(li, KEY3, 80, S.SPLIT_SALT).select(*KEY3, "split")


INDEX_COLUMNS = ["l_returnflag", "l_linestatus", "priority_code"]


@query("string_index", sql=(
    "SELECT variable, value, CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, value ASC) - 1 "
    "AS INTEGER) AS idx FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {c} AS value, count(*) AS n FROM ({S.RECORDS_SQL}) r GROUP BY {c}"
        for c in INDEX_COLUMNS) + ") c"))
def q_string_index(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer
    rec = S.records(spark, sf_dir)
    model = StringIndexer(inputCols=INDEX_COLUMNS, outputCols=[f"{c}_idx" for c in INDEX_COLUMNS],
                          handleInvalid="keep").fit(rec)
    rows = [(c, v, i) for c, lab in zip(INDEX_COLUMNS, model.labelsArray) for i, v in enumerate(lab)]
    return spark.createDataFrame(rows, "variable string, value string, idx int")


@query("one_hot_encode", sql=(
    "WITH f AS (SELECT l_returnflag AS value, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS idx "
    "FROM lineitem GROUP BY l_returnflag) "
    "SELECT l_orderkey, l_linenumber, l_returnflag, "
    "CASE WHEN f.idx = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS ohe_0, "
    "CASE WHEN f.idx = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS ohe_1, "
    "CASE WHEN f.idx = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS ohe_2 "
    "FROM lineitem JOIN f ON lineitem.l_returnflag = f.value"))
def q_one_hot_encode(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    li = S.table(spark, sf_dir, "lineitem")
    spec = regress.FeatureSpec(numeric=(), categorical=("l_returnflag",))
    model = Pipeline(stages=regress.categorical_stages(spec)).fit(li)
    size = len(model.stages[0].labelsArray[0])
    arr = vector_to_array(F.col("slots_of_l_returnflag"))
    return model.transform(li).select("l_orderkey", "l_linenumber", "l_returnflag",
                                      *[arr[i].alias(f"ohe_{i}") for i in range(size)])


def _dev_holdout(spark, sf_dir):
    """Rows before the holdout year (or without a date), and all later ones."""
    li = S.table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    start = F.make_timestamp_ntz(F.lit(S.HOLDOUT_YEAR), *[F.lit(n) for n in (1, 1, 0, 0, 0)])
    shipped = F.col("l_shipdate")  # compared as it is stored, so both conditions reach the scan
    return li.where(shipped.isNull() | (shipped < start)), li.where(shipped >= start)


DEV_SQL = (f"SELECT *, {PCT_SQL} AS pct FROM lineitem "
           f"WHERE NOT coalesce(year(l_shipdate) >= {S.HOLDOUT_YEAR}, FALSE)")
HOLD_WHERE_SQL = f"coalesce(year(l_shipdate) >= {S.HOLDOUT_YEAR}, FALSE)"


def _metrics_sql(src: str, label: str, pred: str, name: str | None = None) -> str:
    model = f"'{name}' AS model, " if name else ""
    return (f"SELECT {model}count(*) AS n, round(avg(abs({label} - {pred})), 4) AS mae, "
            f"round(sqrt(avg(({label} - {pred}) * ({label} - {pred}))), 4) AS rmse, "
            f"round(1 - sum(({label} - {pred}) * ({label} - {pred})) / (var_pop({label}) * count(*)), 6) AS r2 "
            f"FROM {src}")


def _round_metrics(df):
    return df.withColumns({"mae": r4("mae"), "rmse": r4("rmse"), "r2": r6("r2")})


@query("baseline_mean_metrics", sql=(
    f"WITH d AS ({DEV_SQL}), m AS (SELECT avg(l_extendedprice) AS mu FROM d WHERE pct < 80), "
    f"v AS (SELECT l_extendedprice AS y, mu AS p FROM d, m WHERE pct >= 80) "
    + _metrics_sql("v", "y", "p", "baseline_mean")))
def q_baseline_mean_metrics(spark, sf_dir):
    dev, _ = _dev_holdout(spark, sf_dir)
    train, valid = regress.split_frames(dev, KEY3, 80, S.SPLIT_SALT)
    pred = regress.baseline_mean(train, valid, "l_extendedprice")
    m = regress.regression_metrics(pred, "l_extendedprice")
    return _round_metrics(m).select(F.lit("baseline_mean").alias("model"), "n", "mae", "rmse", "r2")


@query("regression_metrics", sql=_metrics_sql("(SELECT l_extendedprice AS y, 50000.0 AS p FROM lineitem) t", "y", "p"))
def q_regression_metrics(spark, sf_dir):
    li = regress.with_constant_prediction(S.table(spark, sf_dir, "lineitem"), F.lit(50000.0))
    return _round_metrics(regress.regression_metrics(li, "l_extendedprice"))


LINEAR_SPEC = regress.FeatureSpec(numeric=("l_quantity", "l_discount", "l_tax"),
                                  categorical=("l_returnflag",), label="y")
STEP_SPEC = regress.FeatureSpec(numeric=("l_quantity",), categorical=("l_returnflag", "l_linestatus"),
                                label="z")


def _linear_sets(spark, sf_dir):
    dev, hold = _dev_holdout(spark, sf_dir)
    dev = dev.withColumn("y", S.linear_target())
    hold = hold.withColumn("y", S.linear_target())
    train, valid = regress.split_frames(dev, KEY3, 80, S.SPLIT_SALT)
    return train, valid, hold


@query("ridge_sweep")
def q_ridge_sweep(spark, sf_dir):
    train, valid, _ = _linear_sets(spark, sf_dir)
    res = regress.ridge_sweep(train, valid, LINEAR_SPEC, keys=KEY3)
    return _round_metrics(res.table)


def _linear_model(spark, sf_dir, train):
    return regress.fit_pipeline(regress.linear_pipeline(LINEAR_SPEC, 0.0), train, LINEAR_SPEC, KEY3)


LINEAR_PRED_SQL = f"SELECT {KEY3_SQL}, round({S.LINEAR_SQL}, 2) AS prediction FROM lineitem"


@query("linreg_predict", sql=LINEAR_PRED_SQL)
def q_linreg_predict(spark, sf_dir):
    train, _, _ = _linear_sets(spark, sf_dir)
    model = _linear_model(spark, sf_dir, train)
    li = S.table(spark, sf_dir, "lineitem")
    return model.transform(li).select(*KEY3, F.round("prediction", 2).alias("prediction"))


@query("rf_sweep")
def q_rf_sweep(spark, sf_dir):
    dev, _ = _dev_holdout(spark, sf_dir)
    train, valid = regress.split_frames(dev.withColumn("z", S.step_target()), KEY3, 80, S.SPLIT_SALT)
    res = regress.forest_sweep(train, valid, STEP_SPEC, configs=((60, 8), (120, 12)), keys=KEY3)
    return _round_metrics(res.table)


@query("rf_predict", sql=f"SELECT {KEY3_SQL}, round({S.STEP_SQL}, 2) AS prediction FROM lineitem")
def q_rf_predict(spark, sf_dir):
    dev, _ = _dev_holdout(spark, sf_dir)
    train, _ = regress.split_frames(dev.withColumn("z", S.step_target()), KEY3, 80, S.SPLIT_SALT)
    model = regress.fit_pipeline(regress.forest_pipeline(STEP_SPEC, num_trees=20, max_depth=5, subset="all"),
                                 train, STEP_SPEC, KEY3)
    li = S.table(spark, sf_dir, "lineitem")
    return model.transform(li).select(*KEY3, F.round("prediction", 2).alias("prediction"))


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    train, valid, _ = _linear_sets(spark, sf_dir)
    ridge = regress.ridge_sweep(train, valid, LINEAR_SPEC, keys=KEY3)
    forest = regress.forest_sweep(train, valid, LINEAR_SPEC, configs=((60, 8), (120, 12)), keys=KEY3)
    base = regress.regression_metrics(regress.baseline_mean(train, valid, "y"), "y")
    lin = regress.regression_metrics(ridge.best_model.transform(valid), "y")
    rf = regress.regression_metrics(forest.best_scored, "y")
    board = regress.leaderboard([("baseline_mean", base), ("linear", lin), ("forest", rf)],
                                baseline_name="baseline_mean")
    return board.withColumns({"mae": r4("mae"), "rmse": r4("rmse"), "r2": r6("r2"),
                              "rmse_vs_best": r6("rmse_vs_best"),
                              "rmse_vs_baseline": r6("rmse_vs_baseline")})


# The real price: its linear fit has a closed form (one measure within one code:
# the slope of deviations from the code's means), and the forest without bootstrap
# over two codes predicts their cells' means.  Neither is exact on the holdout.
PRICE_LINEAR = regress.FeatureSpec(numeric=("l_quantity",), categorical=("l_returnflag",), label="l_extendedprice")
PRICE_FOREST = regress.FeatureSpec(numeric=(), categorical=("l_returnflag", "l_linestatus"), label="l_extendedprice")

SCORED_SQL = f"""
WITH train AS (SELECT * FROM ({DEV_SQL}) d WHERE pct < 80),
mu AS (SELECT avg(l_extendedprice) AS m FROM train),
code AS (SELECT l_returnflag, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM train GROUP BY l_returnflag),
slope AS (SELECT sum((l_quantity - mx) * (l_extendedprice - my)) / sum((l_quantity - mx) * (l_quantity - mx)) AS b
          FROM train JOIN code USING (l_returnflag)),
cell AS (SELECT l_returnflag, l_linestatus, avg(l_extendedprice) AS p FROM train GROUP BY ALL),
scored AS (
    SELECT h.*, h.l_extendedprice AS y, mu.m AS baseline_mean, code.my + slope.b * (h.l_quantity - code.mx) AS linear, cell.p AS forest
    FROM (SELECT *, {HOLD_WHERE_SQL} AS later, {PCT_SQL} AS pct FROM lineitem) h, mu, slope
    LEFT JOIN code ON code.l_returnflag = h.l_returnflag
    LEFT JOIN cell ON cell.l_returnflag = h.l_returnflag AND cell.l_linestatus = h.l_linestatus),
long AS (
    SELECT *, y - prediction AS e FROM (
        SELECT *, 'baseline_mean' AS model, baseline_mean AS prediction FROM scored
        UNION ALL SELECT *, 'linear', linear FROM scored UNION ALL SELECT *, 'forest', forest FROM scored) a)
"""


def _frozen(spark, sf_dir):
    """(training rows, validation rows, holdout, training mean, the two fitted pipelines)."""
    dev, hold = _dev_holdout(spark, sf_dir)
    train, valid = regress.split_frames(dev, KEY3, 80, S.SPLIT_SALT)
    models, mean = regress.fit_pipelines(
        [("linear", regress.linear_pipeline(PRICE_LINEAR, 0.0, tol=1e-13), PRICE_LINEAR),
         ("forest", regress.forest_pipeline(PRICE_FOREST, num_trees=10, max_depth=5, subset="all", bootstrap=False), PRICE_FOREST)],
        train, "l_extendedprice", KEY3)
    return train, valid, hold, mean, models


def _set_metrics_sql(where: str) -> str:
    return (f"SELECT model, count(*) AS n_holdout, count(prediction) AS n_scored, count(prediction) = count(*) AS rows_ok, "
            f"round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse, "
            f"round(1 - sum(e * e) / (var_pop(CASE WHEN e IS NOT NULL THEN y END) * count(e)), 6) AS r2 "
            f"FROM long WHERE {where} GROUP BY model")


@query("holdout_evaluation", sql=SCORED_SQL + _set_metrics_sql("later"))
def q_holdout_evaluation(spark, sf_dir):
    """Baseline, linear and forest on the same held-out rows, in one pass."""
    _, _, hold, mean, models = _frozen(spark, sf_dir)
    return _round_metrics(regress.holdout_evaluation(models, hold, "l_extendedprice", train_mean=mean))


@query("leaderboard_across_sets", sql=SCORED_SQL + f""",
metric AS (
    SELECT 'validation' AS set, * FROM ({_set_metrics_sql("NOT later AND pct >= 80").replace("round(sqrt(avg(e * e)), 4)", "sqrt(avg(e * e))")}) v
    UNION ALL SELECT 'holdout', * FROM ({_set_metrics_sql("later").replace("round(sqrt(avg(e * e)), 4)", "sqrt(avg(e * e))")}) h),
named AS (SELECT *, max(CASE WHEN set = 'validation' THEN rmse END) OVER (PARTITION BY model) AS same,
                 max(CASE WHEN model = 'baseline_mean' THEN rmse END) OVER (PARTITION BY set) AS base FROM metric)
SELECT set, model, n_scored AS n, mae, round(rmse, 4) AS rmse, r2, round((rmse - same) / same, 6) AS rmse_vs_reference,
       round((rmse - base) / base, 6) AS rmse_vs_baseline FROM named""")
def q_leaderboard_across_sets(spark, sf_dir):
    """Each model's RMSE on the holdout against its own on the validation rows,
    and against the baseline's on the same rows."""
    _, valid, hold, mean, models = _frozen(spark, sf_dir)
    metrics = {name: regress.holdout_evaluation(models, rows, "l_extendedprice", train_mean=mean).withColumnRenamed("n_scored", "n")
               for name, rows in (("validation", valid), ("holdout", hold))}
    board = regress.across_sets(metrics, "validation", regress.BASELINE)
    return _round_metrics(board).withColumns({c: r6(c) for c in ("rmse_vs_reference", "rmse_vs_baseline")})


@query("model_roundtrip", sql=LINEAR_PRED_SQL)
def q_model_roundtrip(spark, sf_dir):
    train, _, _ = _linear_sets(spark, sf_dir)
    model = _linear_model(spark, sf_dir, train)
    path = shared_dir(spark, "models", "linear", unique=True)
    store.save_model(model, path)
    loaded = store.load_model(path)
    li = S.table(spark, sf_dir, "lineitem")
    return loaded.transform(li).select(*KEY3, F.round("prediction", 2).alias("prediction"))


@query("forest_roundtrip", sql=f"SELECT {KEY3_SQL}, round({S.STEP_SQL}, 2) AS prediction FROM lineitem")
def q_forest_roundtrip(spark, sf_dir):
    """The winner of a forest sweep, saved, reloaded and scored on all rows."""
    dev, _ = _dev_holdout(spark, sf_dir)
    train, valid = regress.split_frames(dev.withColumn("z", S.step_target()), KEY3, 80, S.SPLIT_SALT)
    sweep = regress.forest_sweep(train, valid, STEP_SPEC, configs=((1, 1), (10, 5)), subset="all", keys=KEY3)
    path = shared_dir(spark, "models", "forest", unique=True)
    store.save_model(sweep.best_model, path)
    scored = store.load_model(path).transform(S.table(spark, sf_dir, "lineitem"))
    return scored.select(*KEY3, F.round("prediction", 2).alias("prediction"))


# ============================================================================
# Diagnostics
# ============================================================================

def _rule_scored(spark, sf_dir):
    return S.table(spark, sf_dir, "lineitem").withColumns(
        {"prediction": S.rule_prediction_a(), "pred_b": S.rule_prediction_b()})


@query("residuals", sql=(f"SELECT {KEY3_SQL}, l_extendedprice AS actual, {S.PRED_A_SQL} AS prediction, "
                         f"round(l_extendedprice - {S.PRED_A_SQL}, 4) AS residual FROM lineitem"))
def q_residuals(spark, sf_dir):
    res = diagnose.residuals(_rule_scored(spark, sf_dir), "l_extendedprice")
    return res.select(*KEY3, F.col("l_extendedprice").alias("actual"), "prediction",
                      r4("residual").alias("residual"))


def _err_sql(group_expr: str, grouping: str, src: str = "lineitem") -> str:
    e = f"(l_extendedprice - {S.PRED_A_SQL})"
    return (f"SELECT '{grouping}' AS grouping, CAST({group_expr} AS VARCHAR) AS group_value, count(*) AS n, "
            f"round(avg(abs({e})), 4) AS mae, round(avg({e}), 4) AS mean_error, "
            f"round(sqrt(avg({e} * {e})), 4) AS rmse FROM {src} GROUP BY {group_expr}")


def _round_errors(df):
    return df.withColumns({"mae": r4("mae"), "mean_error": r4("mean_error"), "rmse": r4("rmse")})


@query("errors_by_group", sql=_err_sql("l_returnflag", "l_returnflag") + " UNION ALL "
       + _err_sql("l_linestatus", "l_linestatus"))
def q_errors_by_group(spark, sf_dir):
    return _round_errors(diagnose.errors_by_group(_rule_scored(spark, sf_dir), "l_extendedprice",
                                                  ["l_returnflag", "l_linestatus"]))


_ERRORS_SQL = ("count(*) AS n, round(avg(abs(e)), 4) AS mae, round(avg(e), 4) AS mean_error, "
               "round(sqrt(avg(e * e)), 4) AS rmse")


@query("holdout_errors_by_group", sql=SCORED_SQL + " UNION ALL ".join(
    f"SELECT model, '{c}' AS grouping, {c} AS group_value, {_ERRORS_SQL} FROM long "
    f"WHERE later AND model != 'baseline_mean' GROUP BY model, {c}" for c in ("l_returnflag", "l_linestatus")))
def q_holdout_errors_by_group(spark, sf_dir):
    """Errors of both fitted models on the held-out rows, by two groupings."""
    _, _, hold, _, models = _frozen(spark, sf_dir)
    scored, names = regress.score_all(hold, models)
    long = regress.by_model(scored, ["l_extendedprice", "l_returnflag", "l_linestatus"], names)
    return _round_errors(diagnose.errors_by_group(long, "l_extendedprice", ["l_returnflag", "l_linestatus"], by=["model"]))


@query("errors_by_quantile_band", sql=SCORED_SQL + f""",
q AS (SELECT quantile_disc(y, 0.5) AS p50, quantile_disc(y, 0.9) AS p90 FROM scored WHERE later)
SELECT model, CASE WHEN y <= p50 THEN '{diagnose.BAND_LABELS[0]}' WHEN y <= p90 THEN '{diagnose.BAND_LABELS[1]}'
              ELSE '{diagnose.BAND_LABELS[2]}' END AS band, {_ERRORS_SQL}
FROM long, q WHERE later AND model != 'baseline_mean' GROUP BY ALL""")
def q_errors_by_quantile_band(spark, sf_dir):
    """Errors of both fitted models by band of the actual price on the held-out rows."""
    _, _, hold, _, models = _frozen(spark, sf_dir)
    scored, names = regress.score_all(hold, models)
    long = regress.by_model(scored, ["l_extendedprice"], names)
    return _round_errors(diagnose.errors_by_band(long, "l_extendedprice", thresholds_from=hold, by=["model"]))


@query("paired_prediction_sample", sql=SCORED_SQL + (
    f"SELECT {', '.join(S.SAMPLE_KEY)}, y AS actual, round(linear, 2) AS linear, round(forest, 2) AS forest FROM scored WHERE later "
    f"ORDER BY md5(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in S.SAMPLE_KEY)}, '42')), "
    f"{', '.join(S.SAMPLE_KEY)} LIMIT 5000"))
def q_paired_prediction_sample(spark, sf_dir):
    """The same sampled keys of the held-out rows, scored by both fitted models."""
    _, _, hold, _, models = _frozen(spark, sf_dir)
    pairs = diagnose.paired_scores(hold, models, S.SAMPLE_KEY, "l_extendedprice", n=5000)
    return pairs.withColumns({name: F.round(name, 2) for name, _ in models})


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
