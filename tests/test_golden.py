"""Recorded values: clocks and zones, time differences, names, lines, updates."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rolepulse.functions import text as X
from rolepulse.functions import times as T
from rolepulse.operators import joins as J
from rolepulse.operators import tableops as O
from rolepulse.sources import flowfiles

NY = "America/New_York"


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def clock(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("local, epoch", [
    ("2016-11-06 00:10:13", 1478405413),
    ("2016-11-06 01:10:13", 1478409013),   # occurs twice: daylight time wins
    ("2016-11-06 02:10:13", 1478416213),
    ("2016-11-06 01:00:20", 1478408420),
    ("2016-03-13 02:30:00", 1457854200),   # skipped: the same as 03:30:00
    ("2016-03-13 03:30:00", 1457854200),
])
def test_local_to_epoch(spark, local, epoch):
    assert one(spark, T.to_epoch(clock(local), NY))[0] == epoch


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_zone_is_an_argument(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        row = one(spark, T.to_epoch(clock("2016-11-06 01:10:13"), NY), T.from_epoch(F.lit(1478409013), NY),
                  T.to_epoch(clock("2012-11-12 13:00:00"), "Asia/Shanghai"),
                  T.from_epoch(F.lit(1352692800), "Asia/Shanghai"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1478409013, "2016-11-06 01:10:13", 1352696400, "2012-11-12 12:00:00")


def test_before_1970(spark):
    assert one(spark, T.from_epoch(F.lit(-1)), T.to_epoch(clock("1969-12-31 23:59:59"))) == ("1969-12-31 23:59:59", -1)


def test_interval_in_daylight_time(spark):
    b, e = clock("2016-07-14 00:00:00"), clock("2016-07-14 00:00:01")
    row = one(spark, T.interval_valid(b, e, NY), T.to_epoch(e, NY), T.interval_valid(e, b, NY))
    assert tuple(row) == (True, 1468468801, False)


@pytest.mark.parametrize("utc, local, dst", [
    ("2016-03-13 06:59:59", "2016-03-13 01:59:59", False),
    ("2016-03-13 07:00:00", "2016-03-13 03:00:00", True),
    ("2016-11-06 05:59:59", "2016-11-06 01:59:59", True),
    ("2016-11-06 06:00:00", "2016-11-06 01:00:00", False),
])
def test_new_york_2016(spark, utc, local, dst):
    r = one(spark, T.utc_to_local(clock(utc), NY).alias("l"))["l"]
    assert (r["local_time"], r["utc_offset"], r["is_dst"]) == (
        dt.datetime.fromisoformat(local), -14400 if dst else -18000, dst)


def test_beijing(spark):
    r = one(spark, T.utc_to_local(clock("2016-07-14 07:26:11"), "Asia/Shanghai").alias("l"))["l"]
    assert (r["local_time"], r["utc_offset"], r["is_dst"]) == (dt.datetime(2016, 7, 14, 15, 26, 11), 28800, False)


def test_timediff(spark):
    def diff(a, b):
        d = T.timediff(clock(a), clock(b))
        return tuple(one(spark, d, T.format_timediff(d)))

    assert diff(None, "2016-01-01 00:00:00") == (None, None)
    assert diff("2016-01-01 00:00:00", "2016-01-01 00:00:00") == (0, "00:00:00")
    assert diff("2016-01-01 00:00:00", "2015-01-01 00:00:00")[1] == "838:59:59"
    assert diff("2015-01-01 00:00:00", "2016-01-01 00:00:00")[1] == "-838:59:59"
    day = diff("2016-01-01 00:00:00", "2015-12-31 00:00:00")[0]
    assert day > 0 and day > T.hms_seconds("23:00:00") and not day > T.hms_seconds("24:00:00")


def test_names_and_positions(spark):
    name = F.lit("2016-11-08_taskflow")
    assert tuple(one(spark, X.name_date(name), X.name_type(name))) == ("2016-11-08", "taskflow")
    assert tuple(one(spark, X.name_date(F.lit("a_b_c")), X.name_type(F.lit("a_b_c")), X.name_type(F.lit("abc")))) == (
        "a", "b_c", None)
    assert tuple(one(spark, X.find_substring(F.lit("abcdefg"), F.lit("cdk")),
                     X.find_substring(F.lit("abcdefg"), F.lit("cde")))) == (-1, 2)
    p = one(spark, X.position_parts(F.lit("(1.9,-3.9,30)")).alias("p"), X.position_parts(F.lit("(1,oops)")).alias("q"))
    assert tuple(p["p"]) == (1, -3, 30) and tuple(p["q"]) == (1, None, None)


def test_sample_flow_line(spark):
    line = spark.createDataFrame([("2016-11-10 00:00:00 635962346 37 20091 accomplished",)], "value string")
    for split in (flowfiles.feature_fields, flowfiles.loader_fields):
        row = flowfiles.typed(line, "taskflow", split).first()
        assert tuple(row) == (dt.datetime(2016, 11, 10), 635962346, 37, 20091, "accomplished")


def test_unknown_type_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown flow type 'chat'; known types: award"):
        flowfiles.typed(spark.createDataFrame([("x",)], "value string"), "chat")


def test_update_from_related_rows(spark):
    roles = spark.createDataFrame(
        [(123, "", dt.datetime(2016, 11, 25, 18, 18, 25)), (9, "x", dt.datetime(2016, 1, 1))],
        "id long, name string, create_time timestamp_ntz")
    flow = spark.createDataFrame(
        [(123, dt.datetime(2016, 11, 11, 11, 11, s)) for s in (12, 11, 13)], "roleid long, log_time timestamp_ntz")
    args = (roles, flow, "id", "roleid", "log_time", "create_time")
    latest = {r["id"]: r["create_time"] for r in J.update_from_latest(*args).collect()}
    earliest = {r["id"]: r["create_time"] for r in J.update_from_earliest(*args).collect()}
    assert latest == {123: dt.datetime(2016, 11, 11, 11, 11, 13), 9: None}
    assert earliest == {123: dt.datetime(2016, 11, 11, 11, 11, 11), 9: None}


def test_ambiguous_lookup_is_an_error_only_when_used(spark):
    people = spark.createDataFrame([(1, "A", "old"), (2, "C", "old")], "id int, city_code string, city_name string")
    cities = spark.createDataFrame([("A", "Ahus"), ("B", "Bonn"), ("B", "Bern")], "code string, name string")
    args = ("city_code", "code", "name", "city_name")
    got = {r["id"]: r["city_name"] for r in J.update_from_lookup(people, cities, *args).collect()}
    assert got == {1: "Ahus", 2: None}
    clash = people.union(spark.createDataFrame([(3, "B", "old")], people.schema))
    with pytest.raises(PySparkException, match="more than one match for code B"):
        J.update_from_lookup(clash, cities, *args).collect()


def test_change_column_type_out_of_range(spark):
    df = spark.createDataFrame([(1,), (300,), (None,)], "nation int")
    assert sorted(r[0] or 0 for r in O.change_column_type(df, "nation", strict=False).collect()) == [0, 0, 1]
    with pytest.raises(PySparkException, match="nation does not fit tinyint: 300"):
        O.change_column_type(df, "nation").collect()


def test_replace_into_resets_unlisted_columns(spark):
    target = spark.createDataFrame([(1, "ann", 5), (2, "bob", 6)], "id int, name string, zone int")
    source = spark.createDataFrame([(2, 1, 70), (2, 2, 71), (3, 3, 72)], "id int, n int, zone int")
    new = O.replace_into(target, source, ["id"], order=["n"])
    assert sorted(map(tuple, new.collect())) == [(1, "ann", 5), (2, None, 71), (3, None, 72)]
    again = O.replace_into(new, source, ["id"], order=["n"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))
