"""Queries over the driver's tables, one per operator family.

Each query is ``fn(spark, data_dir) -> DataFrame`` and, where SQL can say the
same thing, has an equivalent DuckDB statement in ``ORACLE``. Derived doubles
are rounded to 6 decimals on both sides. All queries read whole tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import argmax, round6
from ..operators import dedup, dictionary, impute, lists, metrics, ml, outlier, quality, sampling, stats, summaries
from ..operators.groupstats import group_modes
from ..session import tune
from ..sources import derived as dv
from ..sources.tables import read_table
from ..spec import PanelSpec
from . import credit_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, data_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


TO = dv.ORDERS_SPEC
TE = dv.EVENTS_SPEC
W_TO = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"
W_TO_ALL_F = f"({W_TO} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
W_TO_ALL_P = f"({W_TO} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def repair_value() -> "F.Column":
    """S1 + C5 + B5 on the dirty text: '_' is a placeholder, a trailing '_'
    is stripped, the rest parses as double."""
    return tx.to_number(tx.placeholder_to_null("raw", "_"), "double", "_")


REPAIR_SQL = "try_cast(replace(CASE WHEN raw IN ('_') THEN NULL ELSE raw END, '_', '') AS DOUBLE)"
TO_VALUE_SQL = (f"(SELECT o_orderkey, o_custkey, o_orderdate, {REPAIR_SQL} AS value "
                f"FROM {dv.TO_RAW_SQL})")


def orders_value(spark, d) -> DataFrame:
    return dv.orders_raw(spark, d).select("o_orderkey", "o_custkey", "o_orderdate",
                                          repair_value().alias("value"))


def ffbf_sql(col: str) -> str:
    return (f"coalesce(last_value({col} IGNORE NULLS) OVER {W_TO_ALL_P}, "
            f"first_value({col} IGNORE NULLS) OVER {W_TO_ALL_F})")


# ---------------------------------------------------------------------------
# repair

@query("q_repair_cast", f"""
SELECT o_orderkey, o_custkey, raw, round({REPAIR_SQL}, 6) AS value,
       (raw IS NOT NULL AND raw <> '_' AND {REPAIR_SQL} IS NULL) AS parse_failed
FROM {dv.TO_RAW_SQL}""")
def q_repair_cast(spark, d):
    raw = dv.orders_raw(spark, d)
    v = repair_value()
    return raw.select("o_orderkey", "o_custkey", "raw", round6(v).alias("value"),
                      (F.col("raw").isNotNull() & (F.col("raw") != "_") & v.isNull()).alias("parse_failed"))


# ---------------------------------------------------------------------------
# fills

@query("q_ffill_bfill", f"""
SELECT o_orderkey, o_custkey, round({ffbf_sql('value')}, 6) AS value FROM {TO_VALUE_SQL}""")
def q_ffill_bfill(spark, d):
    out = impute.ffill_bfill(orders_value(spark, d), TO, ["value"])
    return out.select("o_orderkey", "o_custkey", round6("value").alias("value"))


# ---------------------------------------------------------------------------
# audits

@query("q_malformed_audit", f"""
SELECT raw, count(*) AS count FROM {dv.TO_RAW_SQL}
WHERE raw IS NOT NULL AND NOT regexp_full_match(raw, '{tx.UNSIGNED_FLOAT}') GROUP BY raw""")
def q_malformed_audit(spark, d):
    return quality.malformed(dv.orders_raw(spark, d), "raw", tx.UNSIGNED_FLOAT)


SIGNED_TEXT_SQL = ("(SELECT CASE WHEN c_custkey % 13 = 0 THEN '--' ELSE '' END || CASE WHEN c_custkey % 11 = 0 THEN '+' ELSE '' END "
                   "|| CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) || CASE WHEN c_custkey % 7 = 0 THEN '_' ELSE '' END AS value "
                   "FROM customer)")


def _signed_text(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    part = lambda n, t: F.when(k % n == 0, t).otherwise("")
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return c.select(F.concat(part(13, "--"), part(11, "+"), F.col("c_acctbal").cast("long").cast("string"), part(7, "_")).alias("value"))


@query("q_malformed_signed", " UNION ALL ".join(
    f"SELECT '{n}' AS pattern, value, count(*) AS count FROM {SIGNED_TEXT_SQL} WHERE NOT regexp_full_match(value, '{p}') GROUP BY value"
    for n, p in (("signed", tx.SIGNED_FLOAT), ("multi_signed", tx.MULTI_SIGNED_FLOAT))))
def q_malformed_signed(spark, d):
    """C2 with the signed patterns."""
    t = _signed_text(spark, d)
    one, many = (quality.malformed(t, "value", p).withColumn("pattern", F.lit(n))
                 for n, p in (("signed", tx.SIGNED_FLOAT), ("multi_signed", tx.MULTI_SIGNED_FLOAT)))
    return one.unionByName(many).select("pattern", "value", "count")


@query("q_failed_casts", f"""
SELECT 'raw' AS "column", count(*) FILTER (WHERE raw IS NOT NULL AND {REPAIR_SQL} IS NULL) AS failed FROM {dv.TO_RAW_SQL}""")
def q_failed_casts(spark, d):
    """What the repair of the dirty totals does not parse."""
    return quality.failed_casts(dv.orders_raw(spark, d), {"raw": repair_value()})


ACCT_TEXT_SQL = "CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR)"


@query("q_nonint_audit", f"""
SELECT value, count(*) AS count FROM (SELECT {ACCT_TEXT_SQL} AS value FROM customer)
WHERE NOT regexp_full_match(value, '{tx.DIGITS}') GROUP BY value""")
def q_nonint_audit(spark, d):
    c = read_table(spark, d, "customer", ["c_acctbal"])
    t = c.select(F.col("c_acctbal").cast("long").cast("string").alias("value"))
    return quality.malformed(t, "value", tx.DIGITS)


@query("q_key_pattern", """
SELECT contains(c_name, 'Customer#') AS matches, count(*) AS count FROM customer GROUP BY 1""")
def q_key_pattern(spark, d):
    return quality.pattern_counts(read_table(spark, d, "customer", ["c_name"]), "c_name", "Customer#")


@query("q_nulls_by_column", f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate, raw, {REPAIR_SQL} AS value FROM {dv.TO_RAW_SQL})
SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls, count(o_orderkey) AS non_null FROM t
UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL), count(o_custkey) FROM t
UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL), count(o_orderdate) FROM t
UNION ALL SELECT 'raw', count(*) FILTER (WHERE raw IS NULL), count(raw) FROM t
UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL), count(value) FROM t""")
def q_nulls_by_column(spark, d):
    raw = dv.orders_raw(spark, d).withColumn("value", repair_value())
    return stats.null_counts(raw)


@query("q_info", f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate, raw, {REPAIR_SQL} AS value FROM {dv.TO_RAW_SQL})
SELECT 0 AS position, 'o_orderkey' AS "column", 'bigint' AS type, count(o_orderkey) AS non_null FROM t
UNION ALL SELECT 1, 'o_custkey', 'bigint', count(o_custkey) FROM t
UNION ALL SELECT 2, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM t
UNION ALL SELECT 3, 'raw', 'string', count(raw) FROM t
UNION ALL SELECT 4, 'value', 'double', count(value) FROM t""")
def q_info(spark, d):
    raw = dv.orders_raw(spark, d).withColumn("value", repair_value())
    return stats.info(raw)


@query("q_require_complete", f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate, raw FROM {dv.TO_RAW_SQL} WHERE raw IS NOT NULL)
SELECT count(*) AS _rows, least(count(o_orderkey), count(o_custkey), count(o_orderdate), count(raw)) AS min_non_null,
       greatest(count(o_orderkey), count(o_custkey), count(o_orderdate), count(raw)) AS max_non_null,
       least(count(o_orderkey), count(o_custkey), count(o_orderdate), count(raw))
         = greatest(count(o_orderkey), count(o_custkey), count(o_orderdate), count(raw)) AS complete
FROM t""")
def q_require_complete(spark, d):
    raw = quality.require_columns(dv.orders_raw(spark, d), ["o_orderkey", "o_custkey", "o_orderdate", "raw"])
    return quality.completeness(quality.drop_missing_target(raw, "raw"))


# ---------------------------------------------------------------------------
# rules

@query("q_range_rule", f"""
SELECT o_orderkey, round(CASE WHEN value > 450000 OR value <= 5000 THEN NULL ELSE value END, 6) AS value
FROM {TO_VALUE_SQL}""")
def q_range_rule(spark, d):
    v = orders_value(spark, d)
    out = outlier.null_where(v, "value", (F.col("value") > 450000) | (F.col("value") <= 5000))
    return out.select("o_orderkey", round6("value").alias("value"))


EV_FENCE_SQL = """(SELECT min(value) AS min_value, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
  quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lower,
  quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS upper,
  max(value) AS max_value FROM events)"""


@query("q_fences", f"""
SELECT round(min_value, 6) AS min_value, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower,
       round(upper, 6) AS upper, round(max_value, 6) AS max_value FROM {EV_FENCE_SQL}""")
def q_fences(spark, d):
    f = outlier.iqr_fences(dv.events(spark, d, ["value"]), "value")
    return f.select(*[round6(c).alias(c) for c in f.columns])


@query("q_iqr_fence_rule", f"""
SELECT event_id, round(CASE WHEN value > f.upper OR value < 0 THEN NULL ELSE value END, 6) AS value
FROM events, {EV_FENCE_SQL} f""")
def q_iqr_fence_rule(spark, d):
    out = outlier.fence_rule(dv.events(spark, d, ["event_id", "value"]), "value")
    return out.select("event_id", round6("value").alias("value"))


@query("q_fence_untouched", f"""
SELECT CAST(floor(value / 100) AS BIGINT) AS value_hundreds, count(*) AS count FROM events, {EV_FENCE_SQL} f
WHERE NOT (value > f.upper OR value < 0) AND value > f.q3 GROUP BY 1""")
def q_fence_untouched(spark, d):
    """What a repair left alone: values above q3 that the fence kept,
    by hundreds."""
    ev = dv.events(spark, d, ["event_id", "value"])
    f = outlier.iqr_fences(ev, "value")
    kept = ev.crossJoin(F.broadcast(f)).where(~((F.col("value") > F.col("upper")) | (F.col("value") < 0))
                                              & (F.col("value") > F.col("q3")))
    return stats.value_counts(kept.select(F.floor(F.col("value") / 100).cast("long").alias("value_hundreds")),
                              "value_hundreds")


# ---------------------------------------------------------------------------
# describe / summaries

def _describe_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM {table}")
    return " UNION ALL ".join(parts)


@query("q_describe_num", _describe_sql(f"(SELECT CAST(user_id AS DOUBLE) AS user_id, value FROM events)",
                                       ["value", "user_id"]))
def q_describe_num(spark, d):
    out = stats.describe_numeric(dv.events(spark, d, ["value", "user_id"]), ["value", "user_id"])
    return out.select("column", "count", *[round6(c).alias(c) for c in
                                           ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("q_describe_cat", """
WITH t AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
           UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
vc AS (SELECT "column", value, count(*) AS c FROM t WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY c DESC, value) AS rn FROM vc)
SELECT "column", sum(c) AS count, count(*) AS "unique", max(CASE WHEN rn = 1 THEN value END) AS top,
       max(c) AS freq FROM r GROUP BY "column\"""")
def q_describe_cat(spark, d):
    o = read_table(spark, d, "orders", ["o_orderstatus", "o_orderpriority"])
    return stats.describe_categorical(o, ["o_orderstatus", "o_orderpriority"])


def _z_sql(src: str, g: str, v: str) -> str:
    """DuckDB text of G10 over ``src`` grouped by ``g`` (adds med, mad, z)."""
    return f"""(WITH m AS (SELECT *, median({v}) OVER (PARTITION BY {g}) AS med FROM {src}),
s AS (SELECT *, median(abs({v} - med)) OVER (PARTITION BY {g}) AS mad,
      sum(CASE WHEN abs({v} - med) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {g})
        = count({v}) OVER (PARTITION BY {g}) AS alleq FROM m),
mm AS (SELECT max(mad) AS maxmad FROM s WHERE {g} IS NOT NULL)
SELECT s.*, maxmad, CASE WHEN {v} IS NULL THEN NULL WHEN mad <> 0 THEN ({v} - med) / mad
  WHEN alleq THEN {v} * 0 WHEN maxmad <> 0 THEN ({v} - med) / maxmad
  WHEN {v} - med > 0 THEN CAST('inf' AS DOUBLE) WHEN {v} - med < 0 THEN CAST('-inf' AS DOUBLE) ELSE 0.0 END AS z
FROM s, mm)"""


def _fence_row_sql(kind: str, x: str, src: str) -> str:
    return (f"SELECT '{kind}' AS kind, round(min({x}), 6) AS min_value, "
            f"round(quantile_cont({x}, 0.25) - 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)), 6) AS lower, "
            f"round(quantile_cont({x}, 0.75) + 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)), 6) AS upper, "
            f"round(max({x}), 6) AS max_value, round(max(maxmad), 6) AS max_mad FROM {src}")


@query("q_column_summary",
       "WITH z AS " + _z_sql("(SELECT user_id, value FROM events)", "user_id", "value") + " "
       + _fence_row_sql("absolute", "value", "z") + " UNION ALL "
       + _fence_row_sql("median_standardization", "z", "z"))
def q_column_summary(spark, d):
    ev = dv.events(spark, d, ["user_id", "value"])
    summ = summaries.column_summary(ev, TE, "value")
    return summ.select("kind", *[round6(c).alias(c) for c in ("min_value", "lower", "upper", "max_value",
                                                              "max_mad")])


# ---------------------------------------------------------------------------
# frequencies

@query("q_value_counts", "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def q_value_counts(spark, d):
    return stats.value_counts(dv.events(spark, d, ["event_type"]), "event_type")


@query("q_value_share", """
SELECT event_type, round(count(*) / (SELECT count(event_type) FROM events), 6) AS share
FROM events WHERE event_type IS NOT NULL GROUP BY 1""")
def q_value_share(spark, d):
    vs = stats.value_counts(dv.events(spark, d, ["event_type"]), "event_type", normalize=True, name="share")
    return vs.select("event_type", round6("share").alias("share"))


@query("q_nunique_hist", """
SELECT n, count(*) AS groups FROM (SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY 1) GROUP BY 1""")
def q_nunique_hist(spark, d):
    return stats.per_group_hist(dv.events(spark, d, ["user_id", "event_type"]), TE, "event_type", "nunique")


@query("q_count_hist", f"""
SELECT n, count(*) AS groups FROM (SELECT o_custkey, count(value) AS n FROM {TO_VALUE_SQL} GROUP BY 1) GROUP BY 1""")
def q_count_hist(spark, d):
    return stats.per_group_hist(orders_value(spark, d), TO, "value", "count")


MODES_SQL = f"""(WITH vc AS (SELECT o_custkey, bucket, count(*) AS c FROM {dv.TO_BUCKET_SQL}
                 WHERE bucket IS NOT NULL GROUP BY ALL),
  mx AS (SELECT o_custkey, max(c) AS mx FROM vc GROUP BY ALL)
  SELECT vc.o_custkey, bucket, c FROM vc JOIN mx ON vc.o_custkey = mx.o_custkey WHERE c = mx)"""


@query("q_modes", f"SELECT o_custkey, bucket AS mode, c AS freq FROM {MODES_SQL}")
def q_modes(spark, d):
    m = group_modes(dv.orders_bucketed(spark, d), TO, "bucket")
    return m.select("o_custkey", F.col("bucket").alias("mode"), F.col("_c").alias("freq"))


@query("q_num_modes", f"""
WITH g AS (SELECT DISTINCT o_custkey FROM orders),
n AS (SELECT o_custkey, count(*) AS k FROM {MODES_SQL} GROUP BY 1)
SELECT coalesce(k, 0) AS n_modes, count(*) AS groups FROM g LEFT JOIN n USING (o_custkey) GROUP BY 1""")
def q_num_modes(spark, d):
    nm = stats.num_modes(dv.orders_bucketed(spark, d), TO, "bucket")
    return nm.groupBy("n_modes").agg(F.count(F.lit(1)).alias("groups"))


MODE_SHARE_SQL = f"""(WITH g AS (SELECT o_custkey, count(*) AS n_rows, count(bucket) AS non_null
                      FROM {dv.TO_BUCKET_SQL} GROUP BY 1),
  f AS (SELECT o_custkey, max(c) AS mode_freq FROM {MODES_SQL} GROUP BY 1)
  SELECT g.o_custkey, n_rows, non_null, mode_freq,
         CASE WHEN non_null > 0 THEN mode_freq / non_null END AS mode_share
  FROM g LEFT JOIN f ON g.o_custkey = f.o_custkey)"""


@query("q_mode_share", f"""
SELECT o_custkey, n_rows, non_null, mode_freq, round(mode_share, 6) AS mode_share FROM {MODE_SHARE_SQL}""")
def q_mode_share(spark, d):
    ms = stats.mode_share(dv.orders_bucketed(spark, d), TO, "bucket")
    return ms.withColumn("mode_share", round6("mode_share"))


@query("q_mode_dominance", f"""
SELECT round(sum(CASE WHEN mode_share > 0.5 THEN n_rows ELSE 0 END) / sum(n_rows), 6) AS share_over
FROM {MODE_SHARE_SQL} WHERE mode_share IS NOT NULL""")
def q_mode_dominance(spark, d):
    md = stats.mode_dominance(dv.orders_bucketed(spark, d), TO, "bucket")
    return md.select(round6("share_over").alias("share_over"))


# ---------------------------------------------------------------------------
# steps and differences

YEARS_SQL = (f"(SELECT o_orderkey, o_custkey, o_orderdate, try_cast(nullif(regexp_extract(history, "
             f"'{tx.DURATION}', 1), '') AS INTEGER) AS years FROM {dv.TO_DURATION_SQL})")


def orders_years(spark, d):
    h = dv.orders_duration(spark, d)
    y = F.nullif(F.regexp_extract("history", tx.DURATION, 1), F.lit("")).try_cast("int")
    return h.select("o_orderkey", "o_custkey", "o_orderdate", y.alias("years"))


@query("q_step_rule", f"""
WITH t AS (SELECT o_custkey, years - lag(years) OVER ({W_TO}) AS d FROM {YEARS_SQL}),
g AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE d = 0) AS z,
             count(*) FILTER (WHERE d IN (0, 1)) AS zo, count(*) FILTER (WHERE d = 1) AS o FROM t GROUP BY 1)
SELECT (z = n - 1) OR (zo = n - 1 AND o = 1) AS valid, count(*) AS groups FROM g GROUP BY 1""")
def q_step_rule(spark, d):
    sr = stats.step_rule(orders_years(spark, d), TO, "years")
    return sr.groupBy("valid").agg(F.count(F.lit(1)).alias("groups"))


@query("q_net_change", f"""
SELECT o_custkey, coalesce(sum(d), 0) AS net_change FROM
  (SELECT o_custkey, bucket - lag(bucket) OVER ({W_TO}) AS d FROM {dv.TO_BUCKET_SQL}) GROUP BY 1""")
def q_net_change(spark, d):
    return stats.net_change(dv.orders_bucketed(spark, d), TO, "bucket")


@query("q_diff_freq", f"""
SELECT d AS diff, count(*) AS count FROM
  (SELECT bucket - lag(bucket) OVER ({W_TO}) AS d FROM {dv.TO_BUCKET_SQL}) GROUP BY 1""")
def q_diff_freq(spark, d):
    return stats.diff_values(dv.orders_bucketed(spark, d), TO, "bucket")


# ---------------------------------------------------------------------------
# fills by group statistics

@query("q_fill_median", f"""
SELECT o_orderkey, round(coalesce(value, median(value) OVER (PARTITION BY o_custkey)), 6) AS value FROM {TO_VALUE_SQL}""")
def q_fill_median(spark, d):
    out = impute.fill_median(orders_value(spark, d), TO, "value")
    return out.select("o_orderkey", round6("value").alias("value"))


@query("q_set_median", f"""
SELECT o_orderkey, round(median(value) OVER (PARTITION BY o_custkey), 6) AS value FROM {TO_VALUE_SQL}""")
def q_set_median(spark, d):
    out = impute.set_median(orders_value(spark, d), TO, "value")
    return out.select("o_orderkey", round6("value").alias("value"))


MODE_STATS_SQL = f"""(SELECT o_custkey, count(*) AS n_modes, min(bucket) AS mode_min, avg(bucket) AS mode_mean,
  median(bucket) AS mode_median FROM {MODES_SQL} GROUP BY 1)"""


@query("q_fill_mode_median", f"""
SELECT o_orderkey, CAST(coalesce(bucket, CASE WHEN n_modes = 1 THEN mode_min ELSE trunc(mode_median) END) AS BIGINT) AS bucket
FROM {dv.TO_BUCKET_SQL} t LEFT JOIN {MODE_STATS_SQL} m ON t.o_custkey = m.o_custkey""")
def q_fill_mode_median(spark, d):
    out = impute.fill_mode_median_int(dv.orders_bucketed(spark, d), TO, "bucket")
    return out.select("o_orderkey", F.col("bucket").cast("long").alias("bucket"))


@query("q_fill_mode_mean", f"""
SELECT o_orderkey, round(coalesce(bucket, CASE WHEN n_modes = 1 THEN mode_min ELSE mode_mean END), 6) AS bucket
FROM {dv.TO_BUCKET_SQL} t LEFT JOIN {MODE_STATS_SQL} m ON t.o_custkey = m.o_custkey""")
def q_fill_mode_mean(spark, d):
    out = impute.fill_mode_mean(dv.orders_bucketed(spark, d), TO, "bucket")
    return out.select("o_orderkey", round6("bucket").alias("bucket"))


CAT_SQL = (f"(SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN category = '_______' THEN NULL "
           f"ELSE category END AS category FROM {dv.TO_CATEGORY_SQL})")
CAT_MODES_SQL = f"""(WITH vc AS (SELECT o_custkey, category, count(*) AS c FROM {CAT_SQL}
                     WHERE category IS NOT NULL GROUP BY ALL),
  mx AS (SELECT o_custkey, max(c) AS mx FROM vc GROUP BY ALL)
  SELECT vc.o_custkey, count(*) AS n_modes, min(category) AS mode_min FROM vc JOIN mx
  ON vc.o_custkey = mx.o_custkey WHERE c = mx GROUP BY 1)"""


def orders_category(spark, d):
    c = dv.orders_category(spark, d)
    return c.withColumn("category", tx.placeholder_to_null("category", "_______"))


@query("q_fill_mode", f"""
SELECT o_orderkey, coalesce(category, mode_min) AS category
FROM {CAT_SQL} t LEFT JOIN {CAT_MODES_SQL} m USING (o_custkey)""")
def q_fill_mode(spark, d):
    out = impute.fill_mode(orders_category(spark, d), TO, "category")
    return out.select("o_orderkey", "category")


@query("q_mode_or_fill", f"""
SELECT o_orderkey, CASE WHEN n_modes = 1 THEN mode_min ELSE {ffbf_sql('category')} END AS category
FROM {CAT_SQL} t LEFT JOIN {CAT_MODES_SQL} m USING (o_custkey)""")
def q_mode_or_fill(spark, d):
    out = impute.mode_or_fill(orders_category(spark, d), TO, "category")
    return out.select("o_orderkey", "category")


# ---------------------------------------------------------------------------
# deviations

Z_TO_SQL = _z_sql(TO_VALUE_SQL, "o_custkey", "value")


@query("q_robust_z", f"SELECT o_orderkey, round(z, 6) AS z FROM {Z_TO_SQL}")
def q_robust_z(spark, d):
    out = outlier.robust_z(orders_value(spark, d), TO, "value", "z")
    return out.select("o_orderkey", round6("z").alias("z"))


@query("q_rel_dev", f"""
SELECT o_orderkey, round(CASE WHEN med <> 0 THEN (value - med) / med WHEN value - med > 0 THEN CAST('inf' AS DOUBLE)
  WHEN value - med < 0 THEN CAST('-inf' AS DOUBLE) WHEN value - med = 0 THEN 0.0 END, 6) AS rel_dev
FROM (SELECT *, median(value) OVER (PARTITION BY o_custkey) AS med FROM {TO_VALUE_SQL})""")
def q_rel_dev(spark, d):
    out = outlier.rel_dev(orders_value(spark, d), TO, "value", "rel_dev")
    return out.select("o_orderkey", round6("rel_dev").alias("rel_dev"))


@query("q_abs_dev", f"""
SELECT o_orderkey, round(value - median(value) OVER (PARTITION BY o_custkey), 6) AS abs_dev FROM {TO_VALUE_SQL}""")
def q_abs_dev(spark, d):
    out = outlier.abs_dev(orders_value(spark, d), TO, "value", "abs_dev")
    return out.select("o_orderkey", round6("abs_dev").alias("abs_dev"))


@query("q_robust_extremes", f"SELECT o_orderkey, o_custkey, round(z, 6) AS z FROM {Z_TO_SQL} WHERE abs(z) > 2")
def q_robust_extremes(spark, d):
    """Rows whose robust z exceeds the threshold."""
    out = outlier.robust_z(orders_value(spark, d), TO, "value", "z")
    return out.where(F.abs("z") > 2).select("o_orderkey", "o_custkey", round6("z").alias("z"))


@query("q_robust_null", f"""
WITH n AS (SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN abs(z) > 2 THEN NULL ELSE value END AS value
           FROM {Z_TO_SQL})
SELECT o_orderkey, o_custkey, round({ffbf_sql('value')}, 6) AS value FROM n""")
def q_robust_null(spark, d):
    """Flagship: repair -> robust z by customer -> null |z| > 2 -> G1 fill."""
    v = orders_value(spark, d)
    hot = TO.hot_keys(v)
    out = outlier.robust_null(v, TO, "value", 2.0, two_sided=True, hot=hot)
    out = impute.ffill_bfill(out, TO, ["value"], hot=hot)
    return out.select("o_orderkey", "o_custkey", round6("value").alias("value"))


# ---------------------------------------------------------------------------
# two-key rules

def orders_value_bucket(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                        "o_orderpriority"])
    return o.select("o_orderkey", "o_custkey", "o_orderdate",
                    tx.to_number(tx.placeholder_to_null(dv.raw_text(), "_")).alias("value"),
                    dv.bucket_col().alias("bucket"),
                    F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
                    .alias("category"))


VB_SQL = (f"(SELECT o_orderkey, o_custkey, o_orderdate, {REPAIR_SQL.replace('raw', 'r')} AS value, "
          f"bucket, category FROM (SELECT o_orderkey, o_custkey, o_orderdate, {dv.RAW_SQL} AS r, "
          f"{dv.BUCKET_SQL} AS bucket, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS category "
          f"FROM orders))")


@query("q_cond_mode", f"""
WITH vc AS (SELECT o_custkey, bucket, value, count(*) AS c FROM {VB_SQL}
            WHERE value IS NOT NULL AND bucket IS NOT NULL GROUP BY ALL),
mx AS (SELECT o_custkey, bucket, max(c) AS mx FROM vc GROUP BY ALL),
md AS (SELECT vc.o_custkey, vc.bucket, min(value) AS m FROM vc JOIN mx ON vc.o_custkey = mx.o_custkey
       AND vc.bucket = mx.bucket WHERE c = mx GROUP BY ALL)
SELECT o_orderkey, round(CASE WHEN t.bucket IS NOT NULL THEN md.m ELSE t.value END, 6) AS value_mode,
       round(CASE WHEN t.bucket IS NOT NULL THEN md.m END, 6) AS value_c9
FROM {VB_SQL} t LEFT JOIN md ON t.o_custkey = md.o_custkey AND t.bucket = md.bucket""")
def q_cond_mode(spark, d):
    t = orders_value_bucket(spark, d)
    g14 = impute.cond_mode(t, TO, "value", "bucket")
    c9 = g14.withColumn("value_c9", F.when(F.col("bucket").isNull(), F.lit(None)).otherwise(F.col("value")))
    return c9.select("o_orderkey", round6("value").alias("value_mode"), round6("value_c9").alias("value_c9"))


@query("q_fill_two_keys", f"""
SELECT o_orderkey, round(CASE WHEN category IS NULL THEN value ELSE coalesce(
  last_value(value IGNORE NULLS) OVER (PARTITION BY o_custkey, category ORDER BY o_orderdate, o_orderkey
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY o_custkey, category ORDER BY o_orderdate, o_orderkey
                                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END, 6) AS value
FROM {VB_SQL}""")
def q_fill_two_keys(spark, d):
    out = impute.fill_two_keys(orders_value_bucket(spark, d), TO, "value", "category")
    return out.select("o_orderkey", round6("value").alias("value"))


# ---------------------------------------------------------------------------
# counter rebuild, global fill, empty groups

@query("q_counter_rebuild", f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate,
             try_cast(nullif(regexp_extract(history, '{tx.DURATION}', 1), '') AS INTEGER) * 12
             + try_cast(nullif(regexp_extract(history, '{tx.DURATION}', 2), '') AS INTEGER) AS months,
             row_number() OVER ({W_TO}) AS pos FROM {dv.TO_DURATION_SQL}),
a AS (SELECT *, min(months) OVER (PARTITION BY o_custkey) AS mv FROM t),
b AS (SELECT *, min(CASE WHEN months = mv THEN pos END) OVER (PARTITION BY o_custkey) AS mp FROM a)
SELECT o_orderkey, months, mv + (pos - mp) AS rebuilt FROM b""")
def q_counter_rebuild(spark, d):
    h = dv.orders_duration(spark, d).withColumn("months", tx.extract_months("history"))
    out = impute.counter_rebuild(h.withColumn("rebuilt", F.col("months")), TO, "rebuilt")
    return out.select("o_orderkey", "months", F.col("rebuilt").cast("long").alias("rebuilt"))


@query("q_fill_global_mean", f"""
SELECT o_orderkey, round(coalesce(value, (SELECT avg(value) FROM {TO_VALUE_SQL})), 6) AS value FROM {TO_VALUE_SQL}""")
def q_fill_global_mean(spark, d):
    out = impute.fill_global_mean(orders_value(spark, d), "value")
    return out.select("o_orderkey", round6("value").alias("value"))


EMPTY_SQL = f"""(SELECT o_orderkey, o_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE value END AS value
  FROM {TO_VALUE_SQL} v JOIN customer c ON v.o_custkey = c.c_custkey)"""


@query("q_empty_groups", f"""
SELECT o_orderkey, o_custkey FROM (SELECT *, count(value) OVER (PARTITION BY o_custkey) AS n FROM {EMPTY_SQL})
WHERE n = 0""")
def q_empty_groups(spark, d):
    """C14: rows of customers without any value (one segment never reports it)."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_mktsegment"])
    v = orders_value(spark, d).join(c, F.col("o_custkey") == F.col("c_custkey"))
    v = v.withColumn("value", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None)).otherwise(F.col("value")))
    out = quality.empty_groups(v, TO, "value")
    return out.select("o_orderkey", "o_custkey")


# ---------------------------------------------------------------------------
# lists

ITEMS_SQL = (f"list_transform(string_split(coalesce(loans, '{lists.FILLER}'), ', '), "
             f"lambda x: ltrim(x, '{lists.STRIP}'))")


@query("q_list_expand", f"""
SELECT o_orderkey, {", ".join(f"coalesce(items[-{i}], '{lists.FILLER}') AS Last_Loan_{i}" for i in range(5, 0, -1))}
FROM (SELECT o_orderkey, {ITEMS_SQL} AS items FROM {dv.TO_LIST_SQL})""")
def q_list_expand(spark, d):
    lst = dv.orders_list(spark, d).select("o_orderkey", "loans")
    return lists.expand(lst, "loans")


def _vocab_sql(where: str) -> str:
    return (f"WITH i AS (SELECT {ITEMS_SQL} AS items FROM {dv.TO_LIST_SQL} WHERE {where}) "
            f"SELECT DISTINCT unnest(items) AS item FROM i UNION SELECT '{lists.FILLER}' FROM i "
            "HAVING min(len(items)) < max(len(items))")


@query("q_list_vocab", _vocab_sql("true"))
def q_list_vocab(spark, d):
    return lists.vocabulary(dv.orders_list(spark, d), "loans")


@query("q_list_vocab_padded", _vocab_sql("loans IS NOT NULL"))
def q_list_vocab_padded(spark, d):
    """F20 without a missing list: the filler comes from padding alone."""
    return lists.vocabulary(dv.orders_list(spark, d).where(F.col("loans").isNotNull()), "loans")


@query("q_list_len", f"""
SELECT o_orderkey, coalesce(len(string_split(loans, ', ')), 0) AS n_items FROM {dv.TO_LIST_SQL}""")
def q_list_len(spark, d):
    return dv.orders_list(spark, d).select("o_orderkey", lists.count_items("loans").alias("n_items"))


# ---------------------------------------------------------------------------
# dictionary maps

@query("q_map_encode", """
SELECT o_orderkey, monthname(o_orderdate) AS month_name, month(o_orderdate) AS month,
       CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'No' END AS flag_back
FROM orders""")
def q_map_encode(spark, d):
    """S11 both ways: month names -> 1..12; a Yes/No flag encoded as 1/0
    (anything else -> NULL) and decoded back."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"])
    o = o.withColumn("month_name", F.date_format("o_orderdate", "MMMM"))
    yn = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").otherwise("NM")
    flag = tx.map_values(yn, tx.YES_NO, "int")
    return o.select("o_orderkey", "month_name", tx.map_values("month_name", tx.MONTH_NUMBER, "int").alias("month"),
                    tx.map_values(flag, tx.YES_NO_BACK).alias("flag_back"))


# ---------------------------------------------------------------------------
# top-k, preview, semi join, point repair

@query("q_topk_distinct", "SELECT DISTINCT value FROM events WHERE value IS NOT NULL ORDER BY value LIMIT 10")
def q_topk_distinct(spark, d):
    return sampling.top_k_distinct(dv.events(spark, d, ["value"]), "value", 10)


@query("q_preview", "SELECT event_id, user_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 5")
def q_preview(spark, d):
    ev = dv.events(spark, d, ["event_id", "ts", "user_id", "event_type", "value"])
    return sampling.preview(ev, ["ts", "event_id"], 5).select("event_id", "user_id", "event_type", "value")


@query("q_semi", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_semi(spark, d):
    """Membership filter as a left-semi join (the key side is not
    assumed small; AQE broadcasts it only if it measures small)."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    keys = read_table(spark, d, "customer", ["c_custkey", "c_mktsegment"]).where(F.col("c_mktsegment") == "BUILDING")
    return o.join(keys, o.o_custkey == keys.c_custkey, "left_semi")


@query("q_point_repair", f"""
SELECT v.o_orderkey, round(CASE WHEN r.o_orderkey IS NOT NULL THEN NULL ELSE value END, 6) AS value
FROM {TO_VALUE_SQL} v LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') r
ON v.o_orderkey = r.o_orderkey""")
def q_point_repair(spark, d):
    """NULL the cells listed in a repair table keyed by row key."""
    repairs = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]).where(
        F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("_rk"))
    v = orders_value(spark, d)
    out = v.join(repairs, v.o_orderkey == repairs._rk, "left")
    out = outlier.null_where(out, "value", F.col("_rk").isNotNull())
    return out.select("o_orderkey", round6("value").alias("value"))


# ---------------------------------------------------------------------------
# duplicates

@query("q_near_dup", f"""
WITH b AS (SELECT *, floor(value / ((SELECT avg(value) FROM {TO_VALUE_SQL}) * 0.05)) AS bk FROM
           (SELECT v.*, o.o_orderpriority FROM {TO_VALUE_SQL} v JOIN orders o USING (o_orderkey))),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, bk, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM b)
SELECT o_orderkey, o_custkey, round(value, 6) AS value FROM r WHERE rn = 1 OR value IS NULL""")
def q_near_dup(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                        "o_orderpriority"])
    v = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                 tx.to_number(tx.placeholder_to_null(dv.raw_text(), "_")).alias("value"))
    kept = dedup.near_duplicates(v, TO, "value", ["o_orderpriority"], 0.05)
    return kept.select("o_orderkey", "o_custkey", round6("value").alias("value"))


@query("q_dup_count", """
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders))
  AS duplicates FROM orders""")
def q_dup_count(spark, d):
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderstatus", "o_orderpriority"])
    return stats.duplicate_rows(o)


DUP_COLS = ["o_orderkey", "o_custkey", "key_copy", "o_orderstatus", "o_orderpriority", "status_copy"]
DUP_FRAME_SQL = "(SELECT o_orderkey, o_custkey, o_orderkey AS key_copy, o_orderstatus, o_orderpriority, o_orderstatus AS status_copy FROM orders)"
DUP_PAIRS = [("o_orderkey", "o_custkey"), ("o_orderkey", "key_copy"), ("o_custkey", "key_copy"),
             ("o_orderstatus", "o_orderpriority"), ("o_orderstatus", "status_copy"),
             ("o_orderpriority", "status_copy")]


@query("q_dup_columns", " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\" FROM (SELECT count(*) FILTER (WHERE {a} IS DISTINCT FROM {b}) AS n "
    f"FROM {DUP_FRAME_SQL}) WHERE n = 0" for a, b in DUP_PAIRS))
def q_dup_columns(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    o = o.select("o_orderkey", "o_custkey", F.col("o_orderkey").alias("key_copy"), "o_orderstatus",
                 "o_orderpriority", F.col("o_orderstatus").alias("status_copy"))
    return quality.duplicate_columns(o, DUP_COLS)


# ---------------------------------------------------------------------------
# chart data

@query("q_box_stats", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT q.event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_lo,
  round(max(CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
FROM events e JOIN q USING (event_type) GROUP BY q.event_type, q1, median, q3""")
def q_box_stats(spark, d):
    ev = dv.events(spark, d, ["event_type", "value"])
    b = stats.box_stats(ev, PanelSpec(("event_type",)), "value")
    return b.select("event_type", *[round6(c).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    "outliers")


@query("q_density_by_class", """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT event_type, CAST(CASE WHEN (hi - lo) / 20 = 0 THEN 0
        ELSE least(floor((value - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS bin
      FROM events, r WHERE value IS NOT NULL),
c AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY ALL)
SELECT event_type, bin, round(n / sum(n) OVER (PARTITION BY event_type), 6) AS density FROM c""")
def q_density_by_class(spark, d):
    ev = dv.events(spark, d, ["event_type", "value"])
    out = stats.density_by_class(ev, "event_type", "value", 20)
    return out.select("event_type", "bin", round6("density").alias("density"))


# ---------------------------------------------------------------------------
# metrics on a fixed prediction column

CLASS_NAME_SQL = "CASE {c} WHEN 0 THEN 'Good' WHEN 1 THEN 'Poor' WHEN 2 THEN 'Standard' END"


@query("q_confusion", f"""
SELECT {CLASS_NAME_SQL.format(c='y')} AS true_class,
  count(*) FILTER (WHERE yhat = 0) AS pred_Good, count(*) FILTER (WHERE yhat = 1) AS pred_Poor,
  count(*) FILTER (WHERE yhat = 2) AS pred_Standard
FROM {dv.TO_PRED_SQL} GROUP BY y""")
def q_confusion(spark, d):
    p = dv.orders_predictions(spark, d)
    names = ml.index_to_name(ml.CLASSES)
    named = p.select(names(F.col("y")).alias("y"), names(F.col("yhat")).alias("yhat"))
    return metrics.confusion_matrix(named, "y", "yhat", ml.CLASSES)


@query("q_class_metrics", f"""
WITH c AS (SELECT y, yhat, count(*) AS n FROM {dv.TO_PRED_SQL} GROUP BY ALL),
k AS (SELECT y AS c FROM c UNION SELECT yhat FROM c),
per AS (SELECT k.c, coalesce((SELECT sum(n) FROM c WHERE c.y = k.c), 0) AS support,
               coalesce((SELECT sum(n) FROM c WHERE c.yhat = k.c), 0) AS predicted,
               coalesce((SELECT sum(n) FROM c WHERE c.y = k.c AND c.yhat = k.c), 0) AS tp FROM k),
m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM per),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM m)
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(p * support) / sum(support), 6) AS precision,
       round(sum(r * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM f""")
def q_class_metrics(spark, d):
    m = metrics.class_metrics(dv.orders_predictions(spark, d), "y", "yhat")
    return m.select(*[round6(c).alias(c) for c in m.columns])


@query("q_rmse", f"SELECT round(sqrt(avg(power(y - yhat, 2))), 6) AS rmse FROM {dv.TO_PRED_SQL}")
def q_rmse(spark, d):
    return metrics.rmse(dv.orders_predictions(spark, d), "y", "yhat").select(round6("rmse").alias("rmse"))


@query("q_class_distribution", f"""
SELECT {CLASS_NAME_SQL.format(c='y')} AS class, count(*) AS count FROM {dv.TO_PRED_SQL} GROUP BY 1""")
def q_class_distribution(spark, d):
    """class counts of the target."""
    p = dv.orders_predictions(spark, d)
    return stats.value_counts(p.select(ml.index_to_name(ml.CLASSES)(F.col("y")).alias("class")), "class")


# ---------------------------------------------------------------------------
# features

@query("q_onehot", "SELECT o_orderkey, " + ", ".join(
    f"CAST(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS DOUBLE) AS prio_{p.replace('-', '_').replace(' ', '_')}"
    for p in dv.PRIORITIES) + " FROM orders")
def q_onehot(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderpriority"])
    return dictionary.onehot_columns(o, "o_orderpriority", "prio").drop("o_orderpriority")


@query("q_standardise", """
SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS value_std FROM events""")
def q_standardise(spark, d):
    out = ml.standardize(dv.events(spark, d, ["event_id", "value"]), ["value"])
    return out.select("event_id", round6("value_std").alias("value_std"))


@query("q_label_index", """
SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS event_type_idx FROM events""")
def q_label_index(spark, d):
    ev = dv.events(spark, d, ["event_id", "event_type"])
    out = dictionary.label_index(ev, "event_type", "event_type_idx")
    return out.select("event_id", F.col("event_type_idx").cast("int").alias("event_type_idx"))


# ---------------------------------------------------------------------------
# splits and samples: a seeded hash that both engines have

def seeded_sql(seed: int, *cols: str) -> str:
    """SQL of :func:`sampling.seeded_hash`."""
    text = " || '|' || ".join([f"'{seed}'", *[f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def split_sql(seed: int, *cols: str, pct: int = 80) -> str:
    return f"CASE WHEN {seeded_sql(seed, *cols)} % 100 < {pct} THEN 'train' ELSE 'test' END"


@query("q_split", f"SELECT event_id, user_id, {split_sql(42, 'user_id')} AS split FROM events")
def q_split(spark, d):
    """L6 by customer: all of a user's events fall on one side."""
    ev = dv.events(spark, d, ["event_id", "user_id"])
    return sampling.split(ev, ["user_id"], 80, 42).select("event_id", "user_id", "split")


@query("q_sample_groups", f"""
SELECT event_id, user_id, value FROM events WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM events) ORDER BY {seeded_sql(41, 'user_id')}, user_id LIMIT 5)""")
def q_sample_groups(spark, d):
    ev = dv.events(spark, d, ["event_id", "user_id", "value"])
    return sampling.sample_groups(ev, ["user_id"], 5, 41)


@query("q_shuffle", f"""
SELECT event_id, user_id, row_number() OVER (ORDER BY {seeded_sql(42, 'event_id')}, event_id) - 1 AS position FROM events""")
def q_shuffle(spark, d):
    ev = dv.events(spark, d, ["event_id", "user_id"])
    return sampling.shuffle(ev, ["event_id"], 42)


# ---------------------------------------------------------------------------
# classifier

def _embeddings_split(spark, d):
    e = read_table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    e = e.select("vec_id", F.col("label").cast("string").alias("label_name"), ml.embedding_vector())
    return sampling.split(e, ["vec_id"], 80, 42)


def _emb_pipeline(n_dim: int, max_iter: int = 40):
    return ml.classifier_pipeline([], [], "label_name", n_dim, 10, max_iter=max_iter, vector_col="emb_vec",
                                  vector_size=n_dim)


@query("q_mlp_score", f"""
SELECT vec_id, CAST(label AS VARCHAR) AS label, true AS known FROM embeddings
WHERE {split_sql(42, 'vec_id')} = 'test'""")
def q_mlp_score(spark, d):
    """Fit on the train split, save the model
    to the shared checkpoint folder, load it back and score the test split
    with the row id carried through."""
    import uuid

    from pyspark.ml import PipelineModel

    from ..session import scratch_path
    e = _embeddings_split(spark, d)
    n_dim = len(e.select("emb_vec").first()[0])
    train = e.where(F.col("split") == "train")
    model = _emb_pipeline(n_dim).fit(train)
    path = scratch_path(spark, f"mlp-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    scored = ml.decode(loaded, loaded.transform(e.where(F.col("split") == "test")))
    labels = loaded.stages[0].labels
    known = F.col("predicted_label").isin(*labels) & F.col("prediction").between(0, len(labels) - 1)
    return scored.select("vec_id", F.col("label_name").alias("label"), known.alias("known"))


@query("q_mlp_select", f"""
SELECT count(*) AS n_test, true AS best_is_asked, true AS metrics_in_range
FROM embeddings WHERE {split_sql(42, 'vec_id')} = 'test'""")
def q_mlp_select(spark, d):
    """Pick maxIter by validation RMSE, report test metrics."""
    e = _embeddings_split(spark, d)
    n_dim = len(e.select("emb_vec").first()[0])
    train, test = e.where(F.col("split") == "train"), e.where(F.col("split") == "test")
    asked = [{"maxIter": 20}, {"maxIter": 40}]
    model, best, rmses = ml.select_model(_emb_pipeline(n_dim), train, asked, ["vec_id"])
    m = ml.evaluate(model.transform(test))
    share = [m[k] for k in ("accuracy", "weightedPrecision", "weightedRecall", "f1")]
    return spark.createDataFrame(
        [(m["n"], best in asked and min(rmses) == rmses[asked.index(best)],
          all(0 <= x <= 1 for x in share) and m["rmse"] >= 0 and m["logLoss"] >= 0)],
        "n_test long, best_is_asked boolean, metrics_in_range boolean")


# ---------------------------------------------------------------------------
# sources and sinks

@query("q_load_profile", "SELECT count(*) AS rows, (SELECT count(*) FROM (DESCRIBE orders)) AS columns FROM orders")
def q_load_profile(spark, d):
    """A5: rows and columns of a loaded table (one counting aggregate)."""
    o = read_table(spark, d, "orders")
    return o.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(o.columns)).cast("long"))


REGION_SCHEMA = "r_regionkey int, r_name string"


@query("q_csv_roundtrip", """
SELECT 'sample_a' AS sample, r_regionkey, r_name FROM region
UNION ALL SELECT 'sample_b', r_regionkey, r_name FROM region""")
def q_csv_roundtrip(spark, d):
    """Write the table as two CSV samples under the shared
    checkpoint folder, discover them recursively and read them back with a
    declared schema and their source file."""
    import uuid

    from pyspark.sql import types as T

    from ..session import scratch_path
    from ..sources import csv as csvsrc
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    region = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    for s in ("sample_a", "sample_b"):
        csvsrc.write_table(region, f"{base}/{s}", "csv")
    schema = T.StructType.fromDDL(REGION_SCHEMA)
    back = csvsrc.read_panel_csv(spark, base, schema, glob="*.csv")
    return back.select(F.regexp_extract("source_file", r"/(sample_[ab])/", 1).alias("sample"), "r_regionkey", "r_name")


# ---------------------------------------------------------------------------
# the credit-panel recipe and the classifier on its output

def rounded(df: DataFrame) -> DataFrame:
    """Every double to 6 decimals, as the statements give them."""
    return df.select(*[round6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("q_credit_panel", credit_sql.credit_panel_sql({"all": ({}, "true")}))
def q_credit_panel(spark, d):
    """The whole cleaning recipe on the derived 28-column panel."""
    from . import credit_panel
    return rounded(credit_panel.clean(dv.credit_panel_raw(spark, d)))


@query("q_model_panel", credit_sql.MODELLING_SQL)
def q_model_panel(spark, d):
    """The modelling variant of the recipe, from its list of steps."""
    from . import credit_panel, recipe
    return rounded(recipe.modelling_panel(dv.credit_panel_raw(spark, d), credit_panel.SPEC))


CUSTOMER_ID_SQL = "'CUS_0x' || lower(printf('%x', o_custkey))"


CREDIT_TEST_SQL = f"""
WITH t AS (SELECT CASE WHEN c_acctbal + o_totalprice % 3000 < 3000 THEN 0 WHEN c_acctbal + o_totalprice % 3000 < 7500 THEN 1
                       ELSE 2 END AS y FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE {split_sql(42, CUSTOMER_ID_SQL)} = 'test'),
n AS (SELECT count(*) AS c FROM t GROUP BY y)
SELECT CAST(sum(c) AS BIGINT) AS n_test, round(max(c) / sum(c), 6) AS majority_share"""


@query("q_credit_score", f"{CREDIT_TEST_SQL}, true AS metrics_in_range, true AS beats_majority FROM n")
def q_credit_score(spark, d):
    """Clean, split by customer, fit the perceptron on train, check the test
    metrics (L1-L4, L7, L11-L15): shares in range, accuracy above the share
    of the test side's largest class by a tenth."""
    from . import credit_panel, scoring
    cleaned = credit_panel.clean(dv.credit_panel_raw(spark, d))
    m = scoring.train_and_score(cleaned, max_iter=30, on_incomplete="impute")
    share = F.lit(True)
    for c in ("accuracy", "precision", "recall", "f1"):
        share = share & F.col(c).between(0, 1)
    return m.select("n_test", round6("majority").alias("majority_share"),
                    (share & (F.col("rmse") >= 0) & (F.col("log_loss") >= 0)).alias("metrics_in_range"),
                    (F.col("accuracy") > F.col("majority") + 0.1).alias("beats_majority"))


@query("q_credit_minibatch", f"{CREDIT_TEST_SQL}, true AS known, true AS beats_majority FROM n")
def q_credit_minibatch(spark, d):
    """The same panel and split by mini-batches (Adam, a validation
    share by customer, early stopping): known classes, and accuracy above the
    share of the test side's largest class by a tenth."""
    from . import credit_panel, scoring
    scored = scoring.minibatch_score(credit_panel.clean(dv.credit_panel_raw(spark, d)), rate=0.003)
    n = scored.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    per = n.groupBy("actual").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"),
                                  F.bool_and(F.col("predicted").isNotNull()).alias("known"))
    total = F.sum("n")
    return per.agg(total.alias("n_test"), round6(F.max("n") / total).alias("majority_share"), F.bool_and("known").alias("known"),
                   (F.sum("hit") / total > F.max("n") / total + 0.1).alias("beats_majority"))


@query("q_credit_predictions")
def q_credit_predictions(spark, d):
    """The test side's predictions themselves: row id, true and
    predicted class and the probability given to it. No statement can give
    them; the tests hold them to the metrics and the majority share."""
    from . import credit_panel, scoring
    cleaned = credit_panel.clean(dv.credit_panel_raw(spark, d))
    scored = scoring.split_and_score(cleaned, max_iter=30, on_incomplete="impute")
    top = F.array_max(vector_to_array("probability"))
    return scored.select("ID", F.col(scoring.TARGET).alias("actual"), F.col("predicted_label").alias("predicted"), round6(top).alias("probability"))


@query("q_score_file", f"""
SELECT '0x' || lower(printf('%x', o_orderkey)) AS "ID", true AS known FROM orders
WHERE {split_sql(7, CUSTOMER_ID_SQL)} = 'test'""")
def q_score_file(spark, d):
    """Fit on the customers of one side, then load, clean
    (with the training side's scalars), score and write the other side's rows;
    the written file read back."""
    import uuid

    from ..session import scratch_path, stored
    from . import credit_panel, scoring
    raw = sampling.split(dv.credit_panel_raw(spark, d), ["Customer_ID"], 80, 7, col="_side")
    scalars: dict = {}
    cleaned = stored(credit_panel.clean(raw.where("_side = 'train'").drop("_side"),
                                        credit_panel.CreditOptions(scalars=scalars)), "cleaned")
    model = scoring.fit(cleaned, max_iter=10, on_incomplete="impute")
    done = scoring.score_file(model, raw.where("_side = 'test'").drop("_side"), scalars, scratch_path(spark, f"scores-{uuid.uuid4().hex}"))
    return done.select("ID", F.col("Credit_Score").isin(*ml.CLASSES).alias("known"))


@query("q_credit_samples", credit_sql.credit_panel_sql({"a": ({}, "true"), "b": credit_sql.SECOND}, with_sample=True))
def q_credit_samples(spark, d):
    """P5: two samples of one layout with different values, gaps and rows
    through the recipe at once, each as if it were cleaned alone: the sample
    is part of the panel key, and fences, largest MADs and means are its own."""
    from . import credit_panel
    a = dv.credit_panel_raw(spark, d)
    k = F.conv(F.substring("ID", 3, 20), 16, 10).cast("long")
    b = a.withColumns({
        "Total_EMI_per_month": F.col("Total_EMI_per_month") * 40,
        "Num_Credit_Inquiries": F.col("Num_Credit_Inquiries") * 9,
        "Monthly_Balance": F.when(k % 3 == 0, None).otherwise(F.lit("7.5")),
        "Occupation": F.when(k % 3 == 0, F.col("Occupation")).otherwise(F.lit("Miner")),
        "Num_Credit_Card": F.col("Num_Credit_Card") + F.when(k % 2 == 0, 3).otherwise(0),
    }).where(k % 7 > 0)
    both = a.withColumn("sample", F.lit("a")).unionByName(b.withColumn("sample", F.lit("b")))
    spec = PanelSpec(("Customer_ID", "sample"), ("Month", "ID"), id="ID")
    return rounded(credit_panel.clean(both, credit_panel.CreditOptions(keep=("sample",), sample="sample"), spec).select(
        "sample", "ID", *credit_panel.CLEAN_COLUMNS, *[f"Last_Loan_{i}" for i in range(credit_sql.LOANS, 0, -1)], "Credit_Score"))


# ---------------------------------------------------------------------------
# remaining scalar / audit families

@query("q_nunique", """
SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders""")
def q_nunique(spark, d):
    """distinct count per column (NULLs not counted), one aggregate."""
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderstatus", "o_orderpriority"])
    return stats.distinct_counts(o, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("q_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings""")
def q_argmax(spark, d):
    """Index of the largest element of each embedding."""
    e = read_table(spark, d, "embeddings", ["vec_id", "embedding"])
    return e.select("vec_id", argmax("embedding").cast("int").alias("argmax"))


@query("q_range_drop", f"""
SELECT o_orderkey, round(value, 6) AS value FROM {TO_VALUE_SQL}
WHERE NOT coalesce(value > 450000 OR value <= 5000, false)""")
def q_range_drop(spark, d):
    """The rule drops the offending rows instead of nulling them."""
    out = outlier.drop_where(orders_value(spark, d), (F.col("value") > 450000) | (F.col("value") <= 5000))
    return out.select("o_orderkey", round6("value").alias("value"))


@query("q_score_preview", f"""
SELECT o_orderkey, {CLASS_NAME_SQL.format(c='y')} AS actual, {CLASS_NAME_SQL.format(c='yhat')} AS predicted
FROM {dv.TO_PRED_SQL} ORDER BY o_orderkey LIMIT 15""")
def q_score_preview(spark, d):
    """The first 15 rows of actual vs predicted class, by row id."""
    p = dv.orders_predictions(spark, d)
    names = ml.index_to_name(ml.CLASSES)
    named = p.select("o_orderkey", names(F.col("y")).alias("actual"), names(F.col("yhat")).alias("predicted"))
    return sampling.preview(named, ["o_orderkey"], 15)


@query("q_feature_names", """
WITH s AS (SELECT DISTINCT o_orderstatus AS v FROM orders),
p AS (SELECT DISTINCT o_orderpriority AS v FROM orders)
SELECT 0 AS position, 'o_totalprice' AS name
UNION ALL SELECT CAST(row_number() OVER (ORDER BY v) AS INTEGER), 'o_orderstatus_oh_' || v FROM s
UNION ALL SELECT CAST((SELECT count(*) FROM s) + row_number() OVER (ORDER BY v) AS INTEGER),
                 'o_orderpriority_oh_' || v FROM p""")
def q_feature_names(spark, d):
    """Names of the assembled feature vector, from the dictionaries."""
    o = read_table(spark, d, "orders", ["o_totalprice", "o_orderstatus", "o_orderpriority"])
    return dictionary.feature_names(o, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"])


# ---------------------------------------------------------------------------
# rows without a key, statistics per row, NA tokens

NULL_KEY_SQL = f"(SELECT o_orderkey, nullif(o_custkey, CASE WHEN o_orderkey % 23 = 0 THEN o_custkey END) AS k, o_orderdate, value FROM {TO_VALUE_SQL})"
W_NULL = "PARTITION BY k, CASE WHEN k IS NULL THEN o_orderkey END"


@query("q_null_keys", f"""
WITH m AS (SELECT *, median(value) OVER ({W_NULL}) AS med FROM {NULL_KEY_SQL})
SELECT o_orderkey,
  round(coalesce(last_value(value IGNORE NULLS) OVER ({W_NULL} ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 first_value(value IGNORE NULLS) OVER ({W_NULL} ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS filled,
  round(coalesce(value, med), 6) AS median_filled, round(med, 6) AS median_set, CASE WHEN k IS NOT NULL THEN round(value - med, 6) END AS dev,
  round(value - lag(value) OVER ({W_NULL} ORDER BY o_orderdate, o_orderkey), 6) AS diff
FROM m""")
def q_null_keys(spark, d):
    """G1, G4, G5, G12, G13 on a panel where some rows have no customer: such
    a row is in no group and keeps its value."""
    from ..operators.ordered import lag_diff
    v = orders_value(spark, d).withColumn("o_custkey", F.when(F.col("o_orderkey") % 23 != 0, F.col("o_custkey")))
    out = v.withColumns({"filled": F.col("value"), "median_filled": F.col("value"), "median_set": F.col("value")})
    out = impute.ffill_bfill(out, TO, ["filled"])
    out = impute.fill_median(out, TO, "median_filled")
    out = impute.set_median(out, TO, "median_set")
    out = outlier.abs_dev(out, TO, "value", "dev")
    out = lag_diff(out, TO, "value", "diff")
    return out.select("o_orderkey", *[round6(c).alias(c) for c in ("filled", "median_filled", "median_set", "dev", "diff")])


@query("q_group_nunique", f"""
SELECT t.o_orderkey, n FROM {dv.TO_BUCKET_SQL} t
JOIN (SELECT o_custkey, count(DISTINCT bucket) AS n FROM {dv.TO_BUCKET_SQL} GROUP BY 1) g ON t.o_custkey = g.o_custkey""")
def q_group_nunique(spark, d):
    """The group's number of distinct values on every row."""
    return stats.with_group_nunique(dv.orders_bucketed(spark, d), TO, "bucket", "n").select("o_orderkey", "n")


@query("q_z_distribution", f"""
WITH m AS (SELECT o_custkey, value, median(value) OVER (PARTITION BY o_custkey) AS med FROM {TO_VALUE_SQL}),
s AS (SELECT *, median(abs(value - med)) OVER (PARTITION BY o_custkey) AS mad FROM m),
z AS (SELECT CASE WHEN mad <> 0 THEN (value - med) / mad WHEN value = med THEN 0.0 END AS z FROM s WHERE value IS NOT NULL)
SELECT CAST(floor(z) AS BIGINT) AS bin, count(*) AS rows FROM z WHERE z IS NOT NULL GROUP BY 1""")
def q_z_distribution(spark, d):
    """Distribution of the robust z over unit bins (finite values)."""
    z = outlier.robust_z(orders_value(spark, d), TO, "value", "z").where(F.col("z").isNotNull())
    z = z.where(F.abs("z") < float("inf"))
    return z.groupBy(F.floor("z").cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


@query("q_na_tokens", """
SELECT r_regionkey, CASE r_regionkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE r_name END AS r_name,
  CASE WHEN r_regionkey % 5 <> 4 THEN r_regionkey END AS number, r_regionkey % 5 = 4 AS bad
FROM region""")
def q_na_tokens(spark, d):
    """A1, A3: NA tokens and empty cells read as NULL; a cell that does not
    parse is NULL and its line is reported."""
    import uuid

    from pyspark.sql import types as T

    from ..session import scratch_path
    from ..sources import csv as csvsrc
    k = F.col("r_regionkey")
    region = read_table(spark, d, "region", ["r_regionkey", "r_name"]).select(
        k, F.when(k % 4 == 0, "NA").when(k % 4 == 1, "").otherwise(F.col("r_name")).alias("r_name"),
        F.when(k % 5 == 4, "3_").otherwise(k.cast("string")).alias("number"))
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    csvsrc.write_table(region, path, "csv")
    back = csvsrc.read_panel_csv(spark, path, T.StructType.fromDDL("r_regionkey int, r_name string, number int"),
                                 glob="*.csv", corrupt="bad_line")
    return back.select("r_regionkey", "r_name", "number", F.col("bad_line").isNotNull().alias("bad"))
