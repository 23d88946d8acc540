"""Queries: scalar functions over the given tables."""

from pyspark.sql import functions as F

from rolepulse.functions import text as X
from rolepulse.functions import times as T
from rolepulse.registry.base import flow_events, flow_of, query, sql

NY = "America/New_York"


def _orders(spark, d):
    """Orders with a clock that covers every hour of the day."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(
        secs=(F.col("o_orderkey") * 7919 % 86400).cast("decimal(18,6)"))).alias("clock"))


_CLOCK = "(o_orderdate + to_seconds(o_orderkey * 7919 % 86400))"


@query("to_epoch", f"SELECT o_orderkey, CAST(epoch({_CLOCK}) AS BIGINT) AS ts FROM orders")
def to_epoch(spark, d):
    return _orders(spark, d).select("o_orderkey", T.to_epoch(F.col("clock")).alias("ts"))


@query("from_epoch", f"""
    SELECT o_orderkey, strftime(make_timestamp(CAST(epoch({_CLOCK}) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')
           AS clock_text FROM orders""")
def from_epoch(spark, d):
    return _orders(spark, d).select("o_orderkey", T.from_epoch(T.to_epoch(F.col("clock"))).alias("clock_text"))


@query("date_offset", """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY, '%Y-%m-%d') AS first_day,
           strftime(CAST(o_orderdate AS DATE) - INTERVAL 2 DAY, '%Y-%m-%d') AS last_day FROM orders""")
def date_offset(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", T.date_offset(F.col("o_orderdate"), -30).alias("first_day"),
                    T.date_offset(F.col("o_orderdate"), -2).alias("last_day"))


# New York daylight time by the rule in force in the covered years (first Sunday of
# April to last Sunday of October), written without a time-zone database. ``gap``
# marks clocks the spring change skips; they mean the same instant as one hour later.
_NY_DST = f"""
    SELECT o_orderkey, c, c >= s AND c < e AS dst, c >= s AND c < s + INTERVAL 1 HOUR AS gap FROM (
      SELECT o_orderkey, {_CLOCK} AS c,
        make_date(year({_CLOCK}), 4, 1) + CAST((7 - dayofweek(make_date(year({_CLOCK}), 4, 1))) % 7 AS INTEGER)
          + INTERVAL 2 HOUR AS s,
        make_date(year({_CLOCK}), 10, 31) - CAST(dayofweek(make_date(year({_CLOCK}), 10, 31)) AS INTEGER)
          + INTERVAL 2 HOUR AS e
      FROM orders)"""


@query("local_to_epoch_dst", f"""
    SELECT o_orderkey, CAST(epoch(c) AS BIGINT) + CASE WHEN dst AND NOT gap THEN 14400 ELSE 18000 END AS ts
    FROM ({_NY_DST})""")
def local_to_epoch_dst(spark, d):
    return _orders(spark, d).select("o_orderkey", T.to_epoch(F.col("clock"), NY).alias("ts"))


@query("utc_to_local", f"""
    SELECT o_orderkey, {_CLOCK} + INTERVAL 8 HOUR AS shanghai, 28800 AS utc_offset FROM orders""")
def utc_to_local(spark, d):
    local = T.utc_to_local(F.col("clock"), "Asia/Shanghai")
    return _orders(spark, d).select("o_orderkey", local.alias("l")).select(
        "o_orderkey", F.col("l.local_time").alias("shanghai"), F.col("l.utc_offset").alias("utc_offset"))


@query("utc_to_local_dst", f"""
    SELECT o_orderkey, dst AS is_dst, CASE WHEN dst THEN -14400 ELSE -18000 END AS utc_offset,
           CASE WHEN gap THEN c + INTERVAL 1 HOUR ELSE c END AS new_york
    FROM ({_NY_DST})""")
def utc_to_local_dst(spark, d):
    """New York clocks sent to UTC and back: all but skipped ones return, with offset and daylight flag."""
    utc = T.epoch_clock(T.to_epoch(F.col("clock"), NY))
    return _orders(spark, d).select("o_orderkey", T.utc_to_local(utc, NY).alias("l")).select(
        "o_orderkey", F.col("l.is_dst").alias("is_dst"), F.col("l.utc_offset").alias("utc_offset"),
        F.col("l.local_time").alias("new_york"))


@query("interval_valid", """
    SELECT l_orderkey, l_linenumber, o_orderdate < l_shipdate AS valid
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def interval_valid(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderdate")
    valid = T.interval_valid(F.col("o_orderdate"), F.col("l_shipdate"), "Asia/Shanghai")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", valid.alias("valid"))


@query("interval_valid_dst", """
    WITH y AS (
      SELECT o_orderkey, make_date(year(o_orderdate), 4, 1) AS april, make_date(year(o_orderdate), 10, 31) AS october FROM orders),
    changes AS (
      SELECT o_orderkey, april + CAST((7 - dayofweek(april)) % 7 AS INTEGER) + INTERVAL 2 HOUR AS s,
             october - CAST(dayofweek(october) AS INTEGER) + INTERVAL 2 HOUR AS e FROM y),
    ends AS (
      SELECT *, t - INTERVAL 2 HOUR + to_seconds(o_orderkey * 7919 % 14400) AS b,
             t - INTERVAL 2 HOUR + to_seconds(o_orderkey * 104729 % 14400) AS f
      FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN s ELSE e END AS t FROM changes))
    SELECT o_orderkey, b AS begins, f AS ends,
           epoch(b) + CASE WHEN b >= s + INTERVAL 1 HOUR AND b < e THEN 14400 ELSE 18000 END
           < epoch(f) + CASE WHEN f >= s + INTERVAL 1 HOUR AND f < e THEN 14400 ELSE 18000 END AS valid
    FROM ends""")
def interval_valid_dst(spark, d):
    """New York clocks of the four hours around both changes of a year: a skipped clock is the one an hour later."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.year("o_orderdate").alias("y"))
    spring = F.next_day(F.date_sub(F.make_date("y", F.lit(4), F.lit(1)), 1), "Sunday")
    autumn = F.next_day(F.date_sub(F.make_date("y", F.lit(10), F.lit(31)), 7), "Sunday")
    midnight = F.when(F.col("o_orderkey") % 2 == 0, spring).otherwise(autumn).cast("timestamp_ntz")
    after = lambda n: midnight + F.make_dt_interval(secs=(F.col("o_orderkey") * n % 14400).cast("decimal(18,6)"))
    return orders.select("o_orderkey", after(7919).alias("begins"), after(104729).alias("ends")).withColumn(
        "valid", T.interval_valid(F.col("begins"), F.col("ends"), NY))


_DIFF = "CAST(epoch({a}) - epoch({b}) AS BIGINT)"
_CLAMP = f"greatest(least({_DIFF}, 3020399), -3020399)"


@query("timediff", sql(f"""
    SELECT ord, CASE WHEN log_type <> 'award' THEN
             {_CLAMP.format(a="log_time", b="TIMESTAMP '2024-01-15 00:00:00'")} END AS near_diff,
           {_CLAMP.format(a="log_time", b="TIMESTAMP '2023-12-20 00:00:00'")} AS far_diff,
           {_CLAMP.format(a="TIMESTAMP '2023-12-20 00:00:00'", b="log_time")} AS back_diff FROM fl""", "fl"))
def timediff(spark, d):
    """Award rows get no clock, so that NULL in gives NULL out."""
    clock = F.when(F.col("log_type") != "award", F.col("log_time"))
    near, far = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in ("2024-01-15", "2023-12-20"))
    return flow_events(spark, d).select(
        "ord", T.timediff(clock, near).alias("near_diff"), T.timediff(F.col("log_time"), far).alias("far_diff"),
        T.timediff(far, F.col("log_time")).alias("back_diff"))


@query("timediff_text", sql(f"""
    SELECT ord, CASE WHEN s < 0 THEN '-' ELSE '' END || CASE WHEN abs(s) < 36000 THEN '0' ELSE '' END ||
           (abs(s) // 3600) || ':' || lpad(CAST(abs(s) % 3600 // 60 AS VARCHAR), 2, '0') || ':' ||
           lpad(CAST(abs(s) % 60 AS VARCHAR), 2, '0') AS diff
    FROM (SELECT ord, {_CLAMP.format(a="log_time", b="TIMESTAMP '2024-01-15 00:00:00'")} AS s FROM fl)""", "fl"))
def timediff_text(spark, d):
    diff = T.timediff(F.col("log_time"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return flow_events(spark, d).select("ord", T.format_timediff(diff).alias("diff"))


@query("timediff_filter", sql(f"""
    SELECT ord, s > 0 AS later, s > 82800 AS past_23h FROM (
      SELECT ord, {_CLAMP.format(a="log_time", b="TIMESTAMP '2024-01-15 00:00:00'")} AS s FROM fl)
    WHERE s > 86400 OR s < 0""", "fl"))
def timediff_filter(spark, d):
    diff = T.timediff(F.col("log_time"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    rows = flow_events(spark, d).select("ord", diff.alias("s"))
    return rows.where((F.col("s") > T.hms_seconds("24:00:00")) | (F.col("s") < 0)).select(
        "ord", (F.col("s") > 0).alias("later"), (F.col("s") > T.hms_seconds("23:00:00")).alias("past_23h"))


@query("parse_position", sql("""
    SELECT ord, CAST(trunc(value) AS INTEGER) AS x, CAST(trunc(-value) AS INTEGER) AS y, k AS z FROM fl
    WHERE log_type = 'death'""", "fl"))
def parse_position(spark, d):
    deaths = flow_of(flow_events(spark, d, "death"), "death")
    return deaths.select("ord", X.position_parts(F.col("pos")).alias("p")).select("ord", "p.x", "p.y", "p.z")


@query("split_name", sql("""
    SELECT ord, CAST(day AS VARCHAR) AS file_day, log_type || '_' || zone AS file_type FROM fl""", "fl"))
def split_name(spark, d):
    name = F.concat_ws("_", F.col("day").cast("string"), "log_type", "zone")
    return flow_events(spark, d).select("ord", name.alias("name")).select(
        "ord", X.name_date(F.col("name")).alias("file_day"), X.name_type(F.col("name")).alias("file_type"))


@query("find_substring", "SELECT doc_id, CAST(instr(text, 'the') - 1 AS INTEGER) AS at FROM documents")
def find_substring(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", X.find_substring(F.col("text"), F.lit("the")).alias("at"))


@query("array_as_json", sql("""
    SELECT ord, '[' || k || ',' || (ord % 7) || ',null]' AS json, k + ord % 7 AS total FROM fl""", "fl"))
def array_as_json(spark, d):
    values = F.array(F.col("k"), (F.col("ord") % 7).cast("int"), F.lit(None).cast("int"))
    kept = flow_events(spark, d).select("ord", X.array_to_json(values).alias("json"))
    total = F.aggregate(X.json_to_array(F.col("json")), F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0)))
    return kept.select("ord", "json", total.cast("bigint").alias("total"))


@query("safe_ratio", sql("""
    SELECT ord, CASE WHEN k % 10 = 0 THEN 0.0 ELSE round(value / (k % 10), 6) END::DOUBLE AS ratio FROM fl""", "fl"))
def safe_ratio(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(F.col("event_id").alias("ord"), F.round(X.safe_ratio(F.col("value"), k % 10), 6).alias("ratio"))
