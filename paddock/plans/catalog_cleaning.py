"""Queries that exercise the cleaning and parsing rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paddock.functions import rules, text, times
from paddock.operators import summaries as S
from paddock.operators.groups import keep_first
from paddock.plans.catalog import query
from paddock.plans.views import Tables

LINE = ["l_orderkey", "l_linenumber"]


def _time_text() -> Column:
    """M:SS.mmm text made from the line price by whole-number arithmetic; some rows left unreadable."""
    ms = (F.round(F.col("l_extendedprice") * 100) % 600000).cast("long")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    made = F.concat(
        (F.floor(ms / 60000)).cast("string"), F.lit(":"), pad(F.floor((ms % 60000) / 1000), 2), F.lit("."),
        pad(ms % 1000, 3),
    )
    return F.when(F.col("l_linenumber") == 7, F.lit("No Time")).otherwise(made)


TIMED = """timed AS (
  SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) % 600000 AS stored,
    CASE WHEN l_linenumber = 7 THEN 'No Time' ELSE
      CAST(stored // 60000 AS VARCHAR) || ':' || lpad(CAST(stored % 60000 // 1000 AS VARCHAR), 2, '0') || '.'
      || lpad(CAST(stored % 1000 AS VARCHAR), 3, '0') END AS time_text,
    CASE WHEN l_linenumber <> 7 THEN stored::DOUBLE END AS ms
  FROM lineitem)"""


@query("time_to_ms", f"WITH {TIMED} SELECT l_orderkey, l_linenumber, time_text, ms FROM timed", "ms")
def _time_to_ms(t: Tables) -> DataFrame:
    timed = t.lineitem.select(*LINE, _time_text().alias("time_text"))
    return timed.withColumn("ms", times.lap_time_ms("time_text"))


@query("cross_check", f"""WITH {TIMED}
SELECT count(*) FILTER (WHERE abs(ms - (stored + CASE WHEN l_linenumber = 6 THEN 60 ELSE 0 END)) > 50) AS mismatches,
  count(ms) AS compared, count(*) AS laps FROM timed""")
def _cross_check(t: Tables) -> DataFrame:
    stored = (F.round(F.col("l_extendedprice") * 100) % 600000).cast("long") + F.when(
        F.col("l_linenumber") == 6, 60
    ).otherwise(0)
    timed = t.lineitem.select(_time_text().alias("time"), stored.alias("stored"))
    timed = timed.select(times.lap_time_whole_ms("time").alias("ms"), "stored")
    return timed.agg(
        F.count_if(F.abs(F.col("ms") - F.col("stored")) > 50).alias("mismatches"), F.count("ms").alias("compared"),
        F.count(F.lit(1)).alias("laps"),
    )


@query("multi_date", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'bad' END AS raw_date,
  CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed_date,
  CASE WHEN o_orderkey % 3 < 2 THEN CAST(year(o_orderdate) AS INT) END AS parsed_year FROM orders""")
def _multi_date(t: Tables) -> DataFrame:
    third = F.col("o_orderkey") % 3
    raw = (
        F.when(third == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(third == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise("bad")
    )
    out = t.orders.select("o_orderkey", raw.alias("raw_date")).withColumn("d", times.birth_date("raw_date"))
    return out.select(
        "o_orderkey", "raw_date", F.date_format("d", "yyyy-MM-dd").alias("parsed_date"), F.year("d").alias("parsed_year")
    )


@query("time_of_day", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '25:61:00' ELSE strftime(ts, '%H:%M:%S') END AS raw_time,
  CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%H:%M:%S') END AS time FROM events""")
def _time_of_day(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 5 == 0, "25:61:00").otherwise(F.date_format("ts", "HH:mm:ss"))
    out = t.events.select("event_id", raw.alias("raw_time"))
    return out.withColumn("time", times.time_of_day_or_null("raw_time"))


SIZES = """sizes AS (
  SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'E' WHEN 1 THEN 'D' WHEN 2 THEN 'nan' WHEN 3 THEN ' ' || p_size || ' '
    ELSE CAST(p_size AS VARCHAR) END AS raw_size, p_partkey % 10 < 3 AS bad, p_partkey % 10 = 3 AS padded, p_size,
    p_retailprice FROM part)"""


def _sizes(t: Tables) -> DataFrame:
    tenth, size = F.col("p_partkey") % 10, F.col("p_size").cast("string")
    raw = (
        F.when(tenth == 0, "E").when(tenth == 1, "D").when(tenth == 2, "nan")
        .when(tenth == 3, F.concat(F.lit(" "), size, F.lit(" "))).otherwise(size)
    )
    return t.part.select("p_partkey", raw.alias("raw_size"), "p_retailprice")


@query("safe_cast", f"""WITH {SIZES}
SELECT p_partkey, CASE WHEN NOT bad THEN p_size::DOUBLE END AS size, CAST(trunc(p_retailprice) AS INT) AS whole_price
FROM sizes""", "size")
def _safe_cast(t: Tables) -> DataFrame:
    return _sizes(t).select(
        "p_partkey", text.number_or_null("raw_size").alias("size"), F.col("p_retailprice").cast("int").alias("whole_price")
    )


@query("numeric_text_flag", f"""WITH {SIZES}
SELECT NOT bad AND NOT padded AS is_classified, count(*) AS n FROM sizes GROUP BY ALL""")
def _numeric_text_flag(t: Tables) -> DataFrame:
    flagged = _sizes(t).select(text.is_numeric_text("raw_size").alias("is_classified"))
    return S.count_rows("is_classified")(flagged)


@query("clean_dim", """
SELECT c_custkey, c_name, c_nationkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS segment FROM customer""")
def _clean_dim(t: Tables) -> DataFrame:
    dirty = t.customer.withColumns({
        "segment": F.concat(F.lit(" \t"), F.lower("c_mktsegment"), F.lit("  ")), "url": F.lit("x"),
    }).drop("c_mktsegment", "c_acctbal")
    clean = dirty.drop("url", "time", "alt").withColumn("segment", text.title_case(text.strip("segment")))
    return clean.select("c_custkey", "c_name", "c_nationkey", "segment")


@query("derive_code", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'CUS' ELSE 'X' || CAST(c_nationkey AS VARCHAR) END AS code,
  'Customer ' || substring(c_name, 10) AS full_name FROM customer""")
def _derive_code(t: Tables) -> DataFrame:
    parts = F.split("c_name", "#")
    raw = t.customer.select(
        "c_custkey", F.get(parts, F.lit(0)).alias("surname"), F.get(parts, F.lit(1)).alias("number"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("  "))
        .when(F.col("c_custkey") % 2 == 1, F.concat(F.lit(" x"), F.col("c_nationkey").cast("string"))).alias("code"),
    )
    return raw.select(
        "c_custkey", text.short_code("code", "surname").alias("code"),
        text.joined_name(F.concat(F.lit(" "), F.col("surname")), "number").alias("full_name"),
    )


def _gappy(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *LINE, F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
    )


GAPPY = """gappy AS (
  SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax,
    nullif(l_returnflag, 'N') AS flag FROM lineitem)"""


@query("fill_sentinels", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, coalesce(discount, 0) AS discount, coalesce(tax, 0) AS tax,
  coalesce(flag, 'Unknown') AS flag FROM gappy""", "discount tax")
def _fill_sentinels(t: Tables) -> DataFrame:
    return S.fill_nulls(_gappy(t), numbers=["discount", "tax"], texts=["flag"])


@query("median_impute", f"""WITH {GAPPY}
SELECT l_orderkey, l_linenumber, coalesce(discount, (SELECT median(discount) FROM gappy)) AS discount,
  coalesce(tax, (SELECT median(tax) FROM gappy)) AS tax FROM gappy""", "discount tax")
def _median_impute(t: Tables) -> DataFrame:
    return S.impute_median(_gappy(t).drop("flag"), ["discount", "tax"])


@query("drop_nulls", f"WITH {GAPPY} SELECT * FROM gappy WHERE discount IS NOT NULL AND flag IS NOT NULL", "discount tax")
def _drop_nulls(t: Tables) -> DataFrame:
    return _gappy(t).dropna(subset=["discount", "flag"])


REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query("dedup_keep_first", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {REST}) = 1""", "l_quantity l_extendedprice")
def _dedup_keep_first(t: Tables) -> DataFrame:
    kept = keep_first(t.lineitem, LINE, [F.col(c) for c in REST.split(", ")])
    return kept.select(*LINE, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("duplicate_count", """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _duplicate_count(t: Tables) -> DataFrame:
    return S.duplicate_rows(t.lineitem, LINE)


@query("range_violations", """
SELECT 'part size above 40' AS rule, count(*) FILTER (WHERE p_size > 40) AS violations FROM part UNION ALL
SELECT 'part price below 950', count(*) FILTER (WHERE p_retailprice < 950) FROM part UNION ALL
SELECT 'order total below 1000', count(*) FILTER (WHERE o_totalprice < 1000) FROM orders UNION ALL
SELECT 'event value below 1', count(*) FILTER (WHERE value < 1) FROM events UNION ALL
SELECT 'event value above 300', count(*) FILTER (WHERE value > 300) FROM events""")
def _range_violations(t: Tables) -> DataFrame:
    part = S.count_violations(t.part, {
        "part size above 40": F.col("p_size") > 40, "part price below 950": F.col("p_retailprice") < 950,
    })
    orders = S.count_violations(t.orders, {"order total below 1000": F.col("o_totalprice") < 1000})
    events = S.count_violations(t.events, {
        "event value below 1": F.col("value") < 1, "event value above 300": F.col("value") > 300,
    })
    return part.unionByName(orders).unionByName(events)
