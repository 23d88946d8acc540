"""Queries: cohort membership, two-sided deaths, updates from other tables."""

from pyspark.sql import functions as F

from rolepulse.operators import joins as J
from rolepulse.operators.tableops import update_constant as set_constant
from rolepulse.plans import activity as A
from rolepulse.registry.base import AS_OF, cohort_of, flow_events, query, sql


@query("cohort_semi_join", sql("""
    SELECT ord, roleid, log_type, log_time FROM fl WHERE roleid IN (SELECT roleid FROM cohort)""", "cohort"))
def cohort_semi_join(spark, d):
    events = flow_events(spark, d)
    rows = events.select("ord", "roleid", "log_type", "log_time")
    return J.semi_join_keys(rows, cohort_of(spark, d).roles, "roleid")


@query("death_two_sided", sql("""
    SELECT ord, roleid, kind AS side FROM cact WHERE kind IN ('killed', 'killer')""", "cact"))
def death_two_sided(spark, d):
    cohort = cohort_of(spark, d)
    deaths = A.activity_range(flow_events(spark, d, "death"), AS_OF, cohort).select("roleid", "killer", "ord")
    sides = J.death_sides(deaths)
    return J.semi_join_keys(sides, cohort.roles, "roleid").select("ord", "roleid", "side")


@query("update_from_lookup", """
    SELECT c_custkey, c_nationkey, c_name,
           (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS city_name FROM customer""")
def update_from_lookup(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_nationkey", "c_name")
    nations = spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name")
    return J.update_from_lookup(customers, nations, "c_nationkey", "n_nationkey", "n_name", "city_name")


def _roles_and_orders(spark, d):
    roles = spark.read.parquet(f"{d}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.lit(None).cast("timestamp_ntz").alias("create_time"))
    created = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_custkey").alias("roleid"), F.col("o_orderdate").alias("log_time"))
    return roles, created


_FROM = """
    SELECT c_custkey AS id, c_name AS name,
           (SELECT {}(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS create_time FROM customer"""


@query("update_from_latest", _FROM.format("max"))
def update_from_latest(spark, d):
    roles, created = _roles_and_orders(spark, d)
    return J.update_from_latest(roles, created, "id", "roleid", "log_time", "create_time")


@query("update_from_earliest", _FROM.format("min"))
def update_from_earliest(spark, d):
    roles, created = _roles_and_orders(spark, d)
    return J.update_from_earliest(roles, created, "id", "roleid", "log_time", "create_time")


@query("update_constant", "SELECT c_custkey, c_name, 1002 AS c_nationkey FROM customer")
def update_constant(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_name", "c_nationkey")
    return set_constant(customers, "c_nationkey", 1002)
