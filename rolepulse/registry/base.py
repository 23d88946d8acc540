"""Registry plumbing and the SQL building blocks the checks share."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.layouts import FLOW_FIELDS, RAW_FILE, VALID_ZONES
from rolepulse.plans.activity import Cohort, stored_cohort
from rolepulse.session import work_path
from rolepulse.sinks.flowtables import load_flow_table
from rolepulse.sinks.plainfiles import first_lines, write_plain
from rolepulse.sinks.routed import write_routed_in_order
from rolepulse.sources.eventmap import AS_OF, flow_events, flow_of, flow_text, raw_lines
from rolepulse.sources.flowfiles import read_partitioned
from rolepulse.sources.growing import opened_store
from rolepulse.sources.tables import read_flow_table, write_flow_lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

START, END = "2024-01-01", "2024-01-29"   # AS_OF - 30 and AS_OF - 2


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL counterpart."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# Common table expressions: name -> (what it needs, body).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
        SELECT *, CASE event_type WHEN 'signup' THEN 'createrole' WHEN 'click' THEN 'taskflow'
                    WHEN 'error' THEN 'death' WHEN 'view' THEN 'roleloginlogout'
                    WHEN 'purchase' THEN CASE WHEN ord % 2 = 0 THEN 'award' ELSE 'levelup' END END AS log_type
        FROM (SELECT event_id AS ord, user_id AS roleid, CAST(date_trunc('second', ts) AS TIMESTAMP) AS log_time,
                     CAST(ts AS DATE) AS day, event_type, value,
                     CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
                     CASE user_id % 3 WHEN 0 THEN '1002' WHEN 1 THEN '1004' ELSE '1005' END AS zone
              FROM events)"""),
    "fl": (("ev",), """
        SELECT ord, zone, day, log_type, log_time, roleid, k, value,
               CASE WHEN log_type <> 'createrole' THEN k END AS level,
               CASE WHEN log_type IN ('createrole', 'levelup') THEN CAST(roleid % 8 AS INTEGER) END AS profession,
               CASE WHEN log_type = 'createrole' THEN CAST(roleid % 3 AS INTEGER) END AS nation,
               CASE WHEN log_type = 'taskflow' THEN k END AS task_id,
               CASE WHEN log_type = 'taskflow' THEN CASE WHEN ord % 2 = 0 THEN 'accomplished' ELSE 'accepted' END
                    WHEN log_type = 'roleloginlogout' THEN CASE WHEN ord % 2 = 0 THEN 'logout' ELSE 'login' END
               END AS action,
               CASE WHEN log_type = 'roleloginlogout' THEN
                    CASE WHEN ord % 2 = 0 THEN CAST(floor(value) AS INTEGER) ELSE 0 END END AS online_time,
               CASE WHEN log_type = 'levelup' THEN CAST(floor(value * 100) AS INTEGER) END AS usetime,
               CASE WHEN log_type = 'death' THEN (roleid + ord) % 150 END AS killer,
               CASE WHEN log_type = 'death' THEN k END AS killer_level,
               CASE WHEN log_type = 'death' THEN k % 10 END AS scene,
               CASE WHEN log_type = 'death' THEN '(' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ',' ||
                    CAST(-CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ',' || k || ')' END AS pos,
               CASE WHEN log_type = 'award' THEN k END AS award
        FROM ev"""),
    "firstday": (("fl",), f"""
        SELECT min(day) AS day FROM fl
        WHERE log_type = 'createrole' AND day BETWEEN DATE '{START}' AND DATE '{END}'"""),
    "cohort": (("fl", "firstday"), """
        SELECT roleid, log_time AS create_time, profession, nation
        FROM (SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY ord DESC) AS r FROM fl
              WHERE log_type = 'createrole' AND day = (SELECT day FROM firstday)) WHERE r = 1"""),
    "act": (("fl", "firstday"), f"""
        SELECT roleid, log_type AS kind,
               CASE log_type WHEN 'levelup' THEN 0 WHEN 'taskflow' THEN 1 WHEN 'award' THEN 2 ELSE 4 END AS rank,
               day, ord, log_time, CAST(epoch(log_time) AS BIGINT) AS ts, level, usetime, award, online_time,
               scene, value, k
        FROM fl WHERE day BETWEEN (SELECT day FROM firstday) AND DATE '{END}'
          AND (log_type IN ('levelup', 'taskflow', 'award') OR action = 'logout')
        UNION ALL
        SELECT roleid, 'killed', 3, day, ord, log_time, CAST(epoch(log_time) AS BIGINT), level, usetime, award,
               online_time, scene, value, k
        FROM fl WHERE log_type = 'death' AND day BETWEEN (SELECT day FROM firstday) AND DATE '{END}'
        UNION ALL
        SELECT killer, 'killer', 3, day, ord, log_time, CAST(epoch(log_time) AS BIGINT), level, usetime, award,
               online_time, scene, value, k
        FROM fl WHERE log_type = 'death' AND day BETWEEN (SELECT day FROM firstday) AND DATE '{END}'"""),
    "cact": (("act", "cohort"), "SELECT * FROM act WHERE roleid IN (SELECT roleid FROM cohort)"),
    # --- event-time state, by windows over all rows
    "ups": (("cact",), """
        SELECT *, max(level) OVER (PARTITION BY roleid ORDER BY log_time, ord
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pk
        FROM (SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY log_time, rank, ord, kind) AS nth FROM cact)
        WHERE kind = 'levelup'"""),
    "records": (("ups",), """
        SELECT *, max(usetime) OVER (PARTITION BY roleid ORDER BY log_time, ord
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt
        FROM ups WHERE (pk IS NULL AND (level > 0 OR nth = 1)) OR level > greatest(pk, 0)"""),
    "pace": (("records",), """
        SELECT roleid, max(level) AS local_level, max(usetime) AS top_usetime,
               arg_max(CASE WHEN cand THEN usetime - coalesce(pt, 0) END, CASE WHEN cand THEN ord END)
                   AS near_levelup_time,
               arg_max(CASE WHEN cand THEN coalesce(pt, 0) END, CASE WHEN cand THEN ord END) AS last_up_time
        FROM (SELECT *, usetime > coalesce(pt, 0) AND nth > 1 AS cand FROM records) GROUP BY roleid"""),
    "clean": (("cact", "pace"), """
        SELECT a.roleid, CAST(a.last_time AS DATE) AS day, strftime(a.last_time, '%H:%M:%S') AS log_time, a.ts,
               a.taskid_sum, CAST(0 AS BIGINT) AS inst_sum, a.online_sum, CAST(0 AS BIGINT) AS day_act,
               a.killed_times, a.killer_num, CAST(0 AS BIGINT) AS diamond_revive_num,
               coalesce(p.near_levelup_time, 0) AS near_levelup_time, coalesce(a.gift, 0) AS last_gift_id,
               coalesce(p.local_level, 0) AS local_level, coalesce(p.top_usetime, 0) AS local_levelup_time,
               coalesce(p.last_up_time, 0) AS last_up_time,
               coalesce(a.scene, 0) AS logout_scene, coalesce(a.x, 0) AS logout_x, coalesce(a.y, 0) AS logout_y,
               coalesce(a.z, 0) AS logout_z
        FROM (SELECT roleid, max(log_time) AS last_time, max(ts) AS ts,
                     count(*) FILTER (WHERE kind = 'taskflow') AS taskid_sum,
                     CAST(coalesce(sum(online_time) FILTER (WHERE kind = 'roleloginlogout'), 0) AS BIGINT)
                         AS online_sum,
                     count(*) FILTER (WHERE kind = 'killed') AS killed_times,
                     count(*) FILTER (WHERE kind = 'killer') AS killer_num,
                     arg_max(award, ts * 100000000 - ord) FILTER (WHERE kind = 'award') AS gift,
                     arg_max(scene, ord) FILTER (WHERE kind = 'killed') AS scene,
                     arg_max(CAST(trunc(value) AS INTEGER), ord) FILTER (WHERE kind = 'killed') AS x,
                     arg_max(CAST(trunc(-value) AS INTEGER), ord) FILTER (WHERE kind = 'killed') AS y,
                     arg_max(k, ord) FILTER (WHERE kind = 'killed') AS z
              FROM cact GROUP BY roleid) a LEFT JOIN pace p ON p.roleid = a.roleid"""),
    # --- replayed state, one row after the other
    "seq": (("cact",), """
        SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY day, rank, ord, kind) AS nth FROM cact"""),
    "steps": (("seq",), """
        SELECT roleid, nth, ts, CASE kind WHEN 'levelup' THEN level WHEN 'award' THEN least(level, 0) ELSE 0 END
                   AS local_level,
               CASE WHEN kind = 'levelup' THEN usetime ELSE 0 END AS pace, 0 AS prev, 0 AS near, 0 AS gift
        FROM seq WHERE nth = 1
        UNION ALL
        SELECT s.roleid, e.nth,
               CASE WHEN e.kind = 'levelup' AND e.level <= s.local_level THEN s.ts ELSE greatest(s.ts, e.ts) END,
               CASE WHEN e.kind = 'levelup' THEN greatest(s.local_level, e.level)
                    WHEN e.kind = 'award' THEN least(s.local_level, e.level) ELSE s.local_level END,
               CASE WHEN e.kind = 'levelup' AND e.level > s.local_level AND e.usetime > s.pace
                    THEN e.usetime ELSE s.pace END,
               CASE WHEN e.kind = 'levelup' AND e.level > s.local_level AND e.usetime > s.pace
                    THEN s.pace ELSE s.prev END,
               CASE WHEN e.kind = 'levelup' AND e.level > s.local_level AND e.usetime > s.pace
                    THEN e.usetime - s.pace ELSE s.near END,
               CASE WHEN e.kind = 'award' AND e.ts > s.ts THEN e.award ELSE s.gift END
        FROM steps s JOIN seq e ON e.roleid = s.roleid AND e.nth = s.nth + 1"""),
    "replayed": (("steps", "clean"), """
        SELECT f.roleid, CAST(make_timestamp(f.ts * 1000000) AS DATE) AS day,
               strftime(make_timestamp(f.ts * 1000000), '%H:%M:%S') AS log_time, f.ts,
               c.taskid_sum, c.inst_sum, c.online_sum, c.day_act, c.killed_times, c.killer_num, c.diamond_revive_num,
               f.near AS near_levelup_time, f.gift AS last_gift_id, f.local_level, f.pace AS local_levelup_time,
               f.prev AS last_up_time, c.logout_scene, c.logout_x, c.logout_y, c.logout_z
        FROM (SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY nth DESC) AS r FROM steps) f
        JOIN clean c ON c.roleid = f.roleid WHERE f.r = 1"""),
}
_RECURSIVE = {"steps"}

for _src, _tag in (("clean", ""), ("replayed", "_replay")):
    CTES[f"top{_tag}"] = ((_src, "firstday"), f"""
        SELECT max(taskid_sum) AS taskid_sum, max(inst_sum) AS inst_sum, max(online_sum) AS online_sum,
               max(day_act) AS day_act, max(killed_times) AS killed_times, max(killer_num) AS killer_num,
               max(diamond_revive_num) AS diamond_revive_num, max(near_levelup_time) AS near_levelup_time,
               greatest(max(ts), (SELECT CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) FROM firstday)) AS ts
        FROM {_src}""")
    CTES[f"labels_{_src}"] = ((_src, f"top{_tag}"), f"""
        SELECT c.*, t.ts AS max_ts, t.ts - c.ts > 86400 AS is_lost FROM {_src} c, top{_tag} t""")
    CTES[f"feats_{_src}"] = ((f"labels_{_src}", f"top{_tag}"), f"""
        SELECT l.roleid, l.is_lost, CASE WHEN l.is_lost THEN 1.0 ELSE 0.0 END::DOUBLE AS label, """ + ", ".join(
        f"CASE WHEN t.{n} = 0 THEN 0.0 ELSE l.{n}::DOUBLE / t.{n} END AS {n}" for n in (
            "taskid_sum", "inst_sum", "online_sum", "day_act", "killed_times", "killer_num", "diamond_revive_num",
            "near_levelup_time")) + f" FROM labels_{_src} l, top{_tag} t")


def sql(select: str, *needs: str) -> str:
    """A statement with the common table expressions it needs in front."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for n in CTES[name][0]:
            visit(n)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return select
    head = "WITH RECURSIVE " if _RECURSIVE & set(order) else "WITH "
    kept = {n: "" if n in _RECURSIVE else "MATERIALIZED " for n in order}
    return head + ",\n".join(f"{n} AS {kept[n]}({CTES[n][1]})" for n in order) + "\n" + select


def cohort_of(spark: SparkSession, sf_dir: str) -> Cohort:
    """The cohort of the events, from a scan of the role creations alone."""
    return stored_cohort(flow_events(spark, sf_dir, "createrole"), AS_OF)


# --- inputs laid down once per session and data folder ------------------------
_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """Raw log text rendered from all events: ``zone=…/day=…`` folders."""
    def write(path: str) -> None:
        keys = ["zone", "day", "ord"]
        lines = raw_lines(flow_events(spark, sf_dir)).repartitionByRange(*keys).sortWithinPartitions(*keys)
        lines.drop("ord").write.partitionBy("zone", "day").text(path)
    return _once(spark, sf_dir, "rawlog", write)


def grow(spark: SparkSession, sf_dir: str, root: str, turn: int, turns: int = 2) -> None:
    """Append the next of ``turns`` equal pieces, which end inside of lines, to each raw log ``<root>/<zone>/<day>/world2.formatlog``."""
    def append(keys, rows):
        zone, day = (k.as_py() for k in keys)
        text = "".join(f"{v}\n" for v in rows.sort_by("ord").column("value").to_pylist()).encode()
        store, path = opened_store(f"{root}/{zone}/{day}/{RAW_FILE}")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        with store.open_append_stream(path) as f:
            f.write(text[len(text) * turn // turns:len(text) * (turn + 1) // turns])
        return pa.table({"n": [len(text)]})

    lines = raw_lines(flow_events(spark, sf_dir)).withColumn("day", F.col("day").cast("string"))
    lines.groupBy("zone", "day").applyInArrow(append, "n bigint").agg(F.sum("n")).collect()


# The raw text of the queries comes in part files of all three zones.
RAW = {"file_name": "*", "zones": VALID_ZONES}


def flow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow lines of all seven types rendered from all events."""
    events = flow_events(spark, sf_dir)
    out = None
    for t in FLOW_FIELDS:
        text = flow_text(flow_of(events, t), t)
        out = text if out is None else out.unionByName(text)
    return out


def flow_lake(spark: SparkSession, sf_dir: str) -> str:
    """The events of all types as one table."""
    def write(path: str) -> None:
        events = flow_events(spark, sf_dir).drop("k")
        clicks = flow_of(flow_events(spark, sf_dir, "taskflow"), "instance")
        write_flow_lake(events.unionByName(clicks, allowMissingColumns=True), path)
    return _once(spark, sf_dir, "lake", write)


def flow_root(spark: SparkSession, sf_dir: str) -> str:
    """Flow files of all seven types."""
    return _once(spark, sf_dir, "flows", lambda path: write_routed_in_order(flow_lines(spark, sf_dir), "ord", path))


def plain_root(spark: SparkSession, sf_dir: str) -> str:
    """The same lines as plain files, ``<zone>/<day>_<type>``."""
    return _once(spark, sf_dir, "plain", lambda path: write_plain(flow_lines(spark, sf_dir), "ord", path))


def names_root(spark: SparkSession, sf_dir: str) -> str:
    """The first line of each plain file; the names of zone 1005 lack the underscore."""
    def write(path: str) -> None:
        firsts = first_lines(flow_lines(spark, sf_dir).where("log_type <> 'instance'"), "ord")
        write_plain(firsts.where("zone <> '1005'"), "ord", path)
        write_plain(firsts.where("zone = '1005'"), "ord", path, separator="-")
    return _once(spark, sf_dir, "names", write)


def table_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder the loaded flow tables of this session live in."""
    return _once(spark, sf_dir, "tables", lambda path: None)


def loaded_table(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    """A flow table loaded from the flow files."""
    root = table_root(spark, sf_dir)
    lines = read_partitioned(spark, flow_root(spark, sf_dir), [log_type], zones=VALID_ZONES)
    _once(spark, sf_dir, f"load-{log_type}", lambda path: load_flow_table(lines, log_type, root))
    return read_flow_table(spark, root, log_type)


__all__ = [
    "AS_OF", "END", "ORACLES", "QUERIES", "RAW", "START", "cohort_of", "flow_events", "flow_lake", "flow_lines", "flow_of", "flow_root", "flow_text", "grow",
    "loaded_table", "names_root", "plain_root", "query", "raw_lines", "raw_root", "sql", "table_root",
]
