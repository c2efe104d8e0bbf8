"""Operator-level registered queries: each building block of the
reports run on its own over whole benchmark tables, with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelterlens.functions.dates import (day_diff, eomonth, month_end_midnight, month_label,
                                         month_start, week_diff)
from shelterlens.functions.predicates import (concat_null, contains_regex, isin_or_null, last_rule_wins,
                                              ne_keep_null, ne_sql, regex_exclude)
from shelterlens.operators.dedupe import Ord, keep_first, keep_last
from shelterlens.operators.spine import current_year, observed_grid, trailing_months
from shelterlens.operators.timeline import asof_ranged, next_event_ranged
from shelterlens.plans.catalog import register
from shelterlens.plans.kitten import age_band
from shelterlens.plans.oracle_incidence import dd, eom, months_cte, wk
from shelterlens.plans.params import AS_OF, SPINE, TRAILING_END, TRAILING_START
from shelterlens.plans.roles import model_from_driver, with_roles
from shelterlens.sources.tables import read_driver_tables


def _t(spark, sf_dir, *names):
    return read_driver_tables(spark, sf_dir, names)


# Orders per report month, months without orders filled with 0
@register("month_spine_counts", with_roles(f"""
WITH {months_cte()},
c AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ref, count(*) AS n FROM orders GROUP BY 1)
SELECT m.ref AS reference_date, CAST(coalesce(c.n, 0) AS BIGINT) AS n_orders FROM months m LEFT JOIN c ON c.ref = m.ref"""))
def month_spine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"]
    counts = o.groupBy(month_start("o_orderdate").alias("reference_date")).agg(F.count(F.lit(1)).alias("n"))
    spine = F.broadcast(SPINE.frame(spark))  # one row per report month: bounded by the run arguments
    return spine.join(counts, "reference_date", "left").select(
        "reference_date", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"))


# Sunday-week tenure at each intake and its age band
_BAND_SQL = ("CASE WHEN w BETWEEN 0 AND 2 THEN '0-2 wks' WHEN w BETWEEN 3 AND 6 THEN '3-6 wks' "
             "WHEN w BETWEEN 7 AND 12 THEN '7-12 wks' WHEN w BETWEEN 13 AND 20 THEN '13-20 wks' END")


@register("week_diff_tenure_band", with_roles(f"""
SELECT InPrimaryKey, AnimalID, CAST(w AS BIGINT) AS tenure_weeks, {_BAND_SQL} AS band
FROM (SELECT v.InPrimaryKey, v.AnimalID, {wk('a.DateOfBirth', 'v.tin_DateCreated')} AS w
      FROM visits v JOIN animals a ON a.AnimalID = v.AnimalID)"""))
def week_diff_tenure_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model_from_driver(spark, sf_dir)
    v = m["visits"].join(m["animals"].select("AnimalID", "DateOfBirth"), "AnimalID", "inner")
    w = week_diff("DateOfBirth", "tin_DateCreated")
    return v.select("InPrimaryKey", "AnimalID", w.cast("bigint").alias("tenure_weeks"), age_band(w).alias("band"))


# Calendar arithmetic on each stay
@register("date_functions", with_roles(f"""
SELECT InPrimaryKey, CAST({dd('tin_DateCreated', 'tOut_DateCreated')} AS INTEGER) AS stay_days,
       CAST(CAST(tin_DateCreated AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_back,
       last_day(tin_DateCreated) AS month_end, CAST(month(tin_DateCreated) AS INTEGER) AS month_no,
       CAST(date_trunc('month', tin_DateCreated) AS DATE) AS month_first,
       strftime(tin_DateCreated, '%b') AS month_label, strftime(tin_DateCreated, '%b-%Y') AS month_year_label
FROM visits_out"""))
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model_from_driver(spark, sf_dir)["visits_out"]
    t = F.col("tin_DateCreated")
    return v.select("InPrimaryKey", day_diff(t, "tOut_DateCreated").alias("stay_days"),
                    F.add_months(F.to_date(t), -12).alias("year_back"), eomonth(t).alias("month_end"),
                    F.month(t).alias("month_no"), month_start(t).alias("month_first"),
                    month_label(t, "MMM").alias("month_label"), month_label(t, "MMM-yyyy").alias("month_year_label"))


# IN-list on a left-joined column, unmatched rows kept
@register("segment_isin_or_null", with_roles("""
SELECT o.o_orderkey, f.flag FROM orders o
LEFT JOIN (SELECT l_orderkey, max(l_returnflag) AS flag FROM lineitem GROUP BY l_orderkey) f ON f.l_orderkey = o.o_orderkey
WHERE f.flag IN ('R') OR f.flag IS NULL"""))
def segment_isin_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir, "orders", "lineitem")
    flags = t["lineitem"].groupBy("l_orderkey").agg(F.max("l_returnflag").alias("flag"))
    o = t["orders"].join(flags, t["orders"]["o_orderkey"] == flags["l_orderkey"], "left")
    return o.where(isin_or_null("flag", ["R"])).select("o_orderkey", "flag")


# Pandas-style != (NULL kept) next to SQL <> (NULL dropped)
_SURGEON = "Supplier#000000001 1"


@register("null_safe_not_equal", with_roles(f"""
SELECT s_suppkey, surgeon, surgeon IS DISTINCT FROM '{_SURGEON}' AS keep_pandas,
       coalesce(surgeon <> '{_SURGEON}', false) AS keep_sql
FROM (SELECT s_suppkey, s_name || ' ' || (CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS STRING) END)
             AS surgeon FROM supplier)"""))
def null_safe_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier")["supplier"]
    s = s.select("s_suppkey", concat_null("s_name", F.lit(" "), F.when(F.col("s_acctbal") >= 0,
                                                                     F.col("s_nationkey").cast("string")))
                 .alias("surgeon"))
    return s.select("s_suppkey", "surgeon", ne_keep_null("surgeon", _SURGEON).alias("keep_pandas"),
                    F.coalesce(ne_sql("surgeon", _SURGEON), F.lit(False)).alias("keep_sql"))


# Unanchored regex exclusion with NULL text kept
_NAME_PATTERN = "#0+1[0-9]$"


@register("regex_exclude", with_roles(f"""
SELECT c_custkey, c_name FROM customer WHERE NOT coalesce(regexp_matches(c_name, '{_NAME_PATTERN}'), false)"""))
def regex_exclude_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")["customer"]
    return c.where(regex_exclude("c_name", _NAME_PATTERN)).select("c_custkey", "c_name")


# Masked assignments, the last matching rule wins
_RULES = (("^S.*", "starts with S"), (".*L.*", "has L"), ("SMALL", "small"))


@register("last_rule_wins", with_roles("""
SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'SMALL') THEN 'small' WHEN regexp_matches(p_type, '.*L.*')
       THEN 'has L' WHEN regexp_matches(p_type, '^S.*') THEN 'starts with S' ELSE 'Other' END AS cls FROM part"""))
def last_rule_wins_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part")["part"]
    return p.select("p_partkey", last_rule_wins([(contains_regex("p_type", pat), v) for pat, v in _RULES], "Other")
                    .alias("cls"))


# The same person table joined twice, SQL string concatenation propagating NULL
@register("concat_null_propagating", with_roles("""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       s1.s_name || ' ' || (CASE WHEN s1.s_acctbal < 0 THEN NULL ELSE CAST(s1.s_nationkey AS STRING) END) AS SurgeonName,
       s2.s_name || ' ' || (CASE WHEN s2.s_acctbal < 0 THEN NULL ELSE CAST(s2.s_nationkey AS STRING) END) AS AssistantName
FROM lineitem l LEFT JOIN supplier s1 ON s1.s_suppkey = l.l_suppkey LEFT JOIN supplier s2 ON s2.s_suppkey = l.l_suppkey + 1"""))
def concat_null_propagating(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir, "lineitem", "supplier")

    def person(role):
        s = t["supplier"]
        return s.select(F.col("s_suppkey").alias(role + "ID"),
                        concat_null("s_name", F.lit(" "), F.when(F.col("s_acctbal") >= 0,
                                                                F.col("s_nationkey").cast("string"))).alias(role + "Name"))
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                              F.col("l_suppkey").alias("SurgeonID"), (F.col("l_suppkey") + 1).alias("AssistantID"))
    out = li.join(person("Surgeon"), "SurgeonID", "left").join(person("Assistant"), "AssistantID", "left")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "SurgeonName", "AssistantName")


# P9 (Q3): month window closed at 00:00 of the last day; P8: half-open previous-month window
@register("closed_month_window", with_roles(f"""
WITH {months_cte()}
SELECT m.ref AS reference_date, count(*) AS n_lines
FROM months m JOIN lineitem l ON l.l_shipdate >= m.ref AND l.l_shipdate <= {eom('m.ref')}
GROUP BY m.ref"""))
def closed_month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")["lineitem"]
    li = li.withColumn("reference_date", month_start("l_shipdate")).where(
        SPINE.in_spine("reference_date") & (F.col("l_shipdate") <= month_end_midnight("reference_date")))
    return li.groupBy("reference_date").agg(F.count(F.lit(1)).alias("n_lines"))


@register("half_open_month", with_roles(f"""
WITH {months_cte()}
SELECT m.ref AS reference_date, count(*) AS n_lines
FROM months m JOIN lineitem l ON l.l_shipdate >= m.ref - INTERVAL 1 MONTH AND l.l_shipdate < m.ref
GROUP BY m.ref"""))
def half_open_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")["lineitem"]
    li = li.withColumn("reference_date", F.add_months(month_start("l_shipdate"), 1)).where(
        SPINE.in_spine("reference_date"))
    return li.groupBy("reference_date").agg(F.count(F.lit(1)).alias("n_lines"))


# P11 / P12
@register("trailing_13_months", with_roles(f"""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{TRAILING_START}' AND o_orderdate < TIMESTAMP '{TRAILING_END}'"""))
def trailing_13_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"]
    return trailing_months(o, "o_orderdate", AS_OF, 13).select("o_orderkey", "o_orderdate")


@register("current_year", with_roles(f"""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{AS_OF.year}-01-01' AND o_orderdate < TIMESTAMP '{AS_OF.year + 1}-01-01'"""))
def current_year_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"]
    return current_year(o, "o_orderdate", AS_OF).select("o_orderkey", "o_orderdate")


# Days from each location row to the next one of the animal, summed per location
@register("dwell_days", with_roles("""
SELECT AnimalID, Location, CAST(sum(d) AS BIGINT) AS dwell_days, count(*) AS n_rows
FROM (SELECT AnimalID, Location, date_diff('day', CAST(LastUpdated AS DATE),
             CAST(lead(LastUpdated) OVER (PARTITION BY AnimalID ORDER BY LastUpdated, Location) AS DATE)) AS d
      FROM locations)
GROUP BY AnimalID, Location"""))
def dwell_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = model_from_driver(spark, sf_dir)["locations"]
    d = next_event_ranged(loc, ["AnimalID"], "LastUpdated", "d", tie_break=["Location"])
    return d.groupBy("AnimalID", "Location").agg(F.sum("d").cast("bigint").alias("dwell_days"),
                                                 F.count(F.lit(1)).alias("n_rows"))


# Latest qualifying visit strictly before each exam's last treatment
@register("asof_latest_visit", with_roles("""
SELECT ExamID, AnimalID, exam_ts, tin_DateCreated, IntakeType FROM (
  SELECT e.ExamID, e.AnimalID, e.exam_ts, v.tin_DateCreated, v.IntakeType,
         row_number() OVER (PARTITION BY e.ExamID ORDER BY v.tin_DateCreated DESC NULLS LAST, v.IntakeType DESC) AS rn
  FROM (SELECT ExamID, AnimalID, max(StatusDateTime) AS exam_ts FROM treatments GROUP BY ExamID, AnimalID) e
  LEFT JOIN visits v ON v.AnimalID = e.AnimalID AND v.tin_DateCreated < e.exam_ts)
WHERE rn = 1"""))
def asof_latest_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model_from_driver(spark, sf_dir)
    exams = m["treatments"].groupBy("ExamID", "AnimalID").agg(F.max("StatusDateTime").alias("exam_ts"))
    v = m["visits"].select("AnimalID", "tin_DateCreated", "IntakeType")
    return asof_ranged(exams, v, ["AnimalID"], "exam_ts", "tin_DateCreated", ["IntakeType"])


# Order-safe keep-first and keep-last per customer
@register("keep_first", with_roles("""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""))
def keep_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"].select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return keep_first(o, ["o_custkey"], [Ord("o_orderdate"), Ord("o_orderkey")])


@register("keep_last", with_roles("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1"""))
def keep_last_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"].select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_last(o, ["o_custkey"], [Ord("o_orderdate"), Ord("o_totalprice"), Ord("o_orderkey")])


# A10: normalised value counts (share of each priority within its month)
@register("value_counts_share", with_roles("""
SELECT month, o_orderpriority, round(CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY month) AS DOUBLE) * 100, 1) AS pct
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority, count(*) AS n
      FROM orders GROUP BY 1, 2)"""))
def value_counts_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"]
    c = o.groupBy(month_start("o_orderdate").alias("month"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    # one row per (month, priority): the window total runs over a handful of rows per month
    return c.select("month", "o_orderpriority",
                    F.round(F.col("n") / F.sum("n").over(Window.partitionBy("month")) * 100, 1).alias("pct"))


# Outcome values to columns, missing cells 0
@register("pivot_outcome", with_roles("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY 1"""))
def pivot_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")["orders"]
    p = (o.groupBy(month_start("o_orderdate").alias("month")).pivot("o_orderstatus", ["F", "O", "P"])
         .agg(F.count(F.lit(1))))
    return p.select("month", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("F", "O", "P")])


# UNION (distinct) of dead-outcome visits and euthanasia records
@register("union_distinct", with_roles("""
SELECT AnimalID, CAST(tOut_DateCreated AS DATE) AS outcome_date FROM visits_out WHERE OutComeType IN ('Died', 'PreEuthanasia')
UNION
SELECT AnimalID, CAST(DateCreated AS DATE) FROM euthanasia"""))
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model_from_driver(spark, sf_dir)
    a = m["visits_out"].where(F.col("OutComeType").isin("Died", "PreEuthanasia")).select(
        "AnimalID", F.to_date("tOut_DateCreated").alias("outcome_date"))
    b = m["euthanasia"].select("AnimalID", F.to_date("DateCreated").alias("outcome_date"))
    return a.union(b).distinct()


# (segment, month) cells of the observed grid without any returned line
@register("set_difference_months", with_roles(f"""
WITH {months_cte()},
segs AS (SELECT DISTINCT c_mktsegment FROM customer),
present AS (SELECT DISTINCT c.c_mktsegment, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS ref
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
            WHERE l.l_returnflag = 'R')
SELECT s.c_mktsegment, m.ref AS reference_date FROM segs s CROSS JOIN months m
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.c_mktsegment = s.c_mktsegment AND p.ref = m.ref)"""))
def set_difference_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir, "customer", "orders", "lineitem")
    lines = (t["lineitem"].where(F.col("l_returnflag") == "R")
             .join(t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
             .join(t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey"))
    present = lines.select("c_mktsegment", month_start("l_shipdate").alias("reference_date")).distinct()
    # segments x report months: a bounded domain (segments observed, months from the run arguments)
    segs = observed_grid(t["customer"], ["c_mktsegment"])
    cells = segs.select("c_mktsegment", F.explode(F.array(*[F.lit(d) for d in SPINE.months])).alias("reference_date"))
    return cells.join(present, ["c_mktsegment", "reference_date"], "left_anti")
