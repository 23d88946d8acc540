"""Queries: cohort day, maximum, features and lost rate of each zone.

One role has events in all three zones, dealt by event number; zone 1005 opens on the fourth
day, so that its cohort day is a later one.
"""

import re

from pyspark.sql import functions as F

from rolepulse.layouts import MODEL_FEATURES, VALID_ZONES
from rolepulse.plans import zones as Z
from rolepulse.registry.base import AS_OF, CTES, END, START, flow_events, query
from rolepulse.session import materialise

OPENS = "2024-01-04"


def zoned_events(spark, d):
    events = flow_events(spark, d)
    open_zones = F.when(F.col("day") < F.lit(OPENS).cast("date"), 2).otherwise(3)
    names = F.array(*[F.lit(z) for z in VALID_ZONES])
    return events.withColumn("zone", F.element_at(names, (F.col("ord") % open_zones + 1).cast("int")))


# The statements for one population, on roles numbered anew for each zone.
_ZONED = {
    "zall": f"""
        SELECT * REPLACE (CASE z WHEN 0 THEN '1002' WHEN 1 THEN '1004' ELSE '1005' END AS zone,
                          roleid * 3 + z AS roleid, killer * 3 + z AS killer), roleid AS own_id
        FROM (SELECT *, ord % (CASE WHEN day < DATE '{OPENS}' THEN 2 ELSE 3 END) AS z FROM fl)""",
    "zdays": f"""
        SELECT zone, min(day) AS day FROM zall
        WHERE log_type = 'createrole' AND day BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY zone""",
    "zfl": "SELECT a.* FROM zall a JOIN zdays d ON d.zone = a.zone WHERE a.day >= d.day",
    "zfirstday": "SELECT min(day) AS day FROM zdays",
    "zcohort": """
        SELECT DISTINCT a.zone, a.roleid, a.own_id FROM zall a JOIN zdays d ON d.zone = a.zone AND d.day = a.day
        WHERE a.log_type = 'createrole'""",
}
_SHARED = ("act", "cact", "ups", "records", "pace", "clean")


def zoned(select: str) -> str:
    """A statement over the zoned tables."""
    names = {n: f"z{n}" for n in ("fl", "firstday", "cohort", *_SHARED)}
    parts = {n: CTES[n][1] for n in ("ev", "fl")} | _ZONED
    for n in _SHARED:
        parts[f"z{n}"] = re.sub(r"\b(FROM|JOIN) (\w+)\b", lambda m: f"{m[1]} {names.get(m[2], m[2])}", CTES[n][1])
    peaks = ", ".join(f"coalesce(max({n}), 0) AS {n}" for n in MODEL_FEATURES)
    parts["zroles"] = "SELECT h.zone, h.own_id, c.* FROM zclean c JOIN zcohort h ON h.roleid = c.roleid"
    parts["ztop"] = f"""
        SELECT d.zone, {peaks}, greatest(max(r.ts), max(CAST(epoch(CAST(d.day AS TIMESTAMP)) AS BIGINT))) AS ts
        FROM zdays d LEFT JOIN (SELECT * EXCLUDE (day) FROM zroles) r ON r.zone = d.zone GROUP BY d.zone"""
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({body})" for n, body in parts.items()) + select


def _parts(spark, d):
    events = materialise(zoned_events(spark, d), "zoned-events")
    cohorts = Z.zone_cohorts(events, AS_OF)
    roles = Z.role_activity_by_zone(events, AS_OF, cohorts=cohorts)
    return cohorts, roles, Z.zone_max(roles, cohorts.days)


@query("zone_first_available_day", zoned(" SELECT zone, day FROM zdays"))
def zone_first_available_day(spark, d):
    return Z.zone_cohorts(zoned_events(spark, d), AS_OF).days


@query("zone_global_max", zoned(f" SELECT zone, {', '.join(MODEL_FEATURES)}, ts FROM ztop"))
def zone_global_max(spark, d):
    return _parts(spark, d)[2]


@query("zone_normalise_features", zoned(f"""
    SELECT r.zone, r.own_id AS roleid, t.ts - r.ts > 86400 AS is_lost,
           CASE WHEN t.ts - r.ts > 86400 THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
           {', '.join(f'round(CASE WHEN t.{n} = 0 THEN 0.0 ELSE r.{n}::DOUBLE / t.{n} END, 6) AS {n}' for n in MODEL_FEATURES)}
    FROM zroles r JOIN ztop t ON t.zone = r.zone"""))
def zone_normalise_features(spark, d):
    _, roles, top = _parts(spark, d)
    return Z.zone_score(roles, top).select("zone", "roleid", "is_lost", "label", *[F.round(n, 6).alias(n) for n in MODEL_FEATURES])


@query("zone_lost_rate", zoned("""
    SELECT h.zone, round(avg(CASE WHEN r.ts IS NULL THEN NULL WHEN t.ts - r.ts > 86400 THEN 1 ELSE 0 END), 6) AS lost_rate,
           count(r.ts) AS active_roles, count(*) AS cohort_roles
    FROM zcohort h JOIN ztop t ON t.zone = h.zone LEFT JOIN zclean r ON r.roleid = h.roleid GROUP BY h.zone"""))
def zone_lost_rate(spark, d):
    cohorts, roles, top = _parts(spark, d)
    return Z.zone_lost_rate(Z.zone_score(roles, top), cohorts).withColumn("lost_rate", F.round("lost_rate", 6))
