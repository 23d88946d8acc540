"""Queries: table operations, each on tables it creates for itself."""

import uuid

from pyspark.sql import functions as F

from rolepulse.operators import tableops as O
from rolepulse.operators.versioned import BucketedTable
from rolepulse.plans import activity as A
from rolepulse.plans import saving as S
from rolepulse.registry.base import AS_OF, ORACLES, flow_events, flow_of, query, sql
from rolepulse.session import work_path


def scratch_db(spark) -> str:
    """A new database in the shared work folder."""
    name = f"rp_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_path(spark, name)}'")
    return name


def _orders(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


def _role_base(spark, d):
    """A role table from customers."""
    return spark.read.parquet(f"{d}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 2).cast("int").alias("gender"),
        F.col("c_nationkey").alias("profession"), F.lit(1002).alias("zone"),
        F.lit("2023-01-01 00:00:00").cast("timestamp_ntz").alias("create_time"))


@query("replace_into", sql("""
    SELECT c_custkey AS id, c_name AS name, CAST(c_custkey % 2 AS INTEGER) AS gender, c_nationkey AS profession,
           1002 AS zone, TIMESTAMP '2023-01-01 00:00:00' AS create_time
    FROM customer WHERE c_custkey NOT IN (SELECT roleid FROM fl WHERE log_type = 'createrole')
    UNION ALL
    SELECT roleid, NULL, NULL, profession, 1, log_time FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY ord DESC) AS r FROM fl
      WHERE log_type = 'createrole') WHERE r = 1""", "fl"))
def replace_into(spark, d):
    """Names and genders of replaced roles are lost, their zone takes its default."""
    created = flow_of(flow_events(spark, d, "createrole"), "createrole").select(
        F.col("roleid").alias("id"), "profession", F.col("log_time").alias("create_time"), "ord").distinct()
    new = O.replace_into(_role_base(spark, d), created, ["id"], order=["ord"], defaults={"zone": F.lit(1)})
    return O.write_version(new, work_path(spark, "role_base"))


@query("replace_into_buckets", ORACLES["replace_into"])
def replace_into_buckets(spark, d):
    """The same on a bucketed table, in two versions: only buckets with a created role are written anew."""
    created = flow_of(flow_events(spark, d, "createrole"), "createrole").select(
        F.col("roleid").alias("id"), "profession", F.col("log_time").alias("create_time"), "ord").distinct()
    old = _role_base(spark, d)
    table = BucketedTable(spark, work_path(spark, "buckets"), old.schema, ["id"], 32)
    table.create(old)
    for half in (F.col("id") % 2 == 0, F.col("id") % 2 == 1):
        table.replace(created.where(half), ["ord"], {"zone": F.lit(1)})
    return table.read()


@query("replace_into_twice", sql("""
    SELECT c_custkey AS id, c_name AS name, CAST(c_custkey % 2 AS INTEGER) AS gender, c_nationkey AS profession,
           1002 AS zone, TIMESTAMP '2023-01-01 00:00:00' AS create_time
    FROM customer WHERE c_custkey NOT IN (SELECT roleid FROM fl WHERE log_type = 'createrole')
    UNION ALL
    SELECT roleid, NULL, NULL, NULL, 1004, max(log_time) FROM fl WHERE log_type = 'createrole' GROUP BY roleid""", "fl"))
def replace_into_twice(spark, d):
    """All columns given, some as constants; replacing again changes nothing."""
    created = flow_of(flow_events(spark, d, "createrole"), "createrole").select(
        F.col("roleid").alias("id"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("gender"),
        F.lit(None).cast("int").alias("profession"), F.lit(1004).alias("zone"), F.col("log_time").alias("create_time"))
    once = O.write_version(O.replace_into(_role_base(spark, d), created, ["id"], order=["create_time"]),
                           work_path(spark, "role_base"))
    return O.replace_into(once, created, ["id"], order=["create_time"])


_ACT = ", ".join(S.ROLE_ACT_FLOW)


@query("save_role_activity", sql(f"""
    SELECT {_ACT} FROM (
      SELECT DATE '2023-12-31' AS day, '00:00:00' AS log_time, 5 AS task_sum, 5 AS inst_sum, 5 AS day_act,
             5 AS killed_times, 5 AS diamond_revive, 5 AS last_gift_id, 5 AS online_time, 5 AS logout_scene,
             5 AS levelup_lasttime, 5 AS logout_pos_x, 5 AS logout_pos_y, 5 AS logout_pos_z, roleid + 1 AS id, roleid,
             5 AS killer_sum, 5 AS init30_level
      FROM (SELECT DISTINCT roleid FROM fl) WHERE roleid NOT IN (SELECT roleid FROM replayed)
      UNION ALL
      SELECT day, log_time, taskid_sum, inst_sum, day_act, killed_times, diamond_revive_num, 0, online_sum, NULL, NULL,
             NULL, NULL, NULL,
             (SELECT max(roleid) + 1 FROM fl) + row_number() OVER (ORDER BY roleid), roleid, killer_num, NULL
      FROM replayed)""", "replayed", "fl"))
def save_role_activity(spark, d):
    """Every known role has an old row of fives; the active cohort roles get theirs replaced."""
    events = flow_events(spark, d)
    five = F.lit(5)
    old = events.select("roleid").distinct().select(*[
        F.col("roleid") if c == "roleid" else (F.col("roleid") + 1).alias("id") if c == "id"
        else F.lit("2023-12-31").cast("date").alias(c) if c == "day"
        else F.lit("00:00:00").alias(c) if c == "log_time" else five.cast(t).alias(c)
        for c, t in S.ROLE_ACT_FLOW.items()])
    return S.save_role_activity(old, A.role_activity(events, AS_OF, replay=True))


@query("save_role_base", sql("""
    SELECT c_custkey AS id, c_name AS name, 1 AS gender, 0 AS profession, 1002 AS zone,
           TIMESTAMP '2023-01-01 00:00:00' AS create_time, 0 AS nation
    FROM customer WHERE c_custkey NOT IN (SELECT roleid FROM cohort)
    UNION ALL
    SELECT roleid, NULL, NULL, profession, NULL, create_time, nation FROM cohort""", "cohort"))
def save_role_base(spark, d):
    known = {"id": F.col("c_custkey"), "name": F.col("c_name"), "gender": F.lit(1), "profession": F.lit(0),
             "zone": F.lit(1002), "create_time": F.lit("2023-01-01 00:00:00"), "nation": F.lit(0)}
    old = spark.read.parquet(f"{d}/customer.parquet").select(*[
        known[c].cast(t).alias(c) for c, t in S.ROLE_BASE.items()])
    new = S.save_role_base(old, A.read_cohort(flow_events(spark, d, "createrole"), AS_OF))
    return new.withColumns({c: F.col(c).cast("int") for c in ("gender", "profession")})


@query("create_table_as", _ORDERS)
def create_table_as(spark, d):
    return O.create_table_as(_orders(spark, d), f"{scratch_db(spark)}.orders_copy")


@query("create_table_like", _ORDERS + " WHERE o_totalprice < 200000")
def create_table_like(spark, d):
    """The clone holds only what is put into it afterwards."""
    db = scratch_db(spark)
    O.create_table_as(_orders(spark, d), f"{db}.orders_copy")
    O.create_table_like(spark, f"{db}.orders_like", f"{db}.orders_copy")
    O.insert_select(_orders(spark, d), F.col("o_totalprice") < 200000, f"{db}.orders_like")
    return spark.table(f"{db}.orders_like")


@query("insert_select_where", _ORDERS + " UNION ALL " + _ORDERS + " WHERE o_orderkey < 1000000 AND o_totalprice < 200000")
def insert_select_where(spark, d):
    table = f"{scratch_db(spark)}.orders_copy"
    O.create_table_as(_orders(spark, d), table)
    O.insert_select(_orders(spark, d), (F.col("o_orderkey") < 1000000) & (F.col("o_totalprice") < 200000), table)
    return spark.table(table)


@query("truncate_table", _ORDERS + " WHERE o_totalprice < 200000")
def truncate_table(spark, d):
    """Nothing of the first content is left when new rows come in."""
    table = f"{scratch_db(spark)}.orders_copy"
    O.create_table_as(_orders(spark, d), table)
    O.truncate_table(spark, table)
    O.insert_select(_orders(spark, d), F.col("o_totalprice") < 200000, table)
    return spark.table(table)


@query("rename_table", _ORDERS)
def rename_table(spark, d):
    """Renamed inside its database, then moved to another."""
    one, two = scratch_db(spark), scratch_db(spark)
    O.create_table_as(_orders(spark, d), f"{one}.old_table")
    O.rename_table(spark, f"{one}.old_table", f"{one}.new_table")
    return O.rename_table(spark, f"{one}.new_table", f"{two}.new_table")


@query("add_column_default", "SELECT *, 0 AS nation FROM (" + _ORDERS + ")")
def add_column_default(spark, d):
    return O.add_column_default(_orders(spark, d), "nation")


@query("change_column_type", "SELECT c_custkey, CAST(c_nationkey AS TINYINT) AS c_nationkey FROM customer")
def change_column_type(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_nationkey")
    return O.change_column_type(customers, "c_nationkey", "tinyint")


@query("copy_database", """
    SELECT 'nation' AS name, count(*) AS row_count FROM nation UNION ALL
    SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer""")
def copy_database(spark, d):
    one, two = scratch_db(spark), scratch_db(spark)
    for t in ("nation", "orders", "customer"):
        O.create_table_as(spark.read.parquet(f"{d}/{t}.parquet"), f"{one}.{t}")
    counts = [spark.table(f"{two}.{t}").agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("row_count"))
              for t in O.copy_database(spark, one, two)]
    return A.union_flows(counts)


@query("copy_partitioned_table", sql("SELECT zone, CAST(day AS VARCHAR) AS day, roleid, level, usetime FROM fl WHERE log_type = 'levelup'", "fl"))
def copy_partitioned_table(spark, d):
    """Zone and day stay folders of the copy; read back by folder."""
    one, two = scratch_db(spark), scratch_db(spark)
    ups = flow_of(flow_events(spark, d, "levelup"), "levelup").select("roleid", "level", "usetime", "zone", F.col("day").cast("string").alias("day"))
    O.create_table_as(ups, f"{one}.ups", ["zone", "day"])
    O.copy_database(spark, one, two)
    folders = spark.sql(f"SHOW PARTITIONS {two}.ups").select(
        F.regexp_extract("partition", "zone=([^/]*)", 1).alias("zone"), F.regexp_extract("partition", "day=([^/]*)", 1).alias("day"))
    return spark.table(f"{two}.ups").join(folders, ["zone", "day"])
