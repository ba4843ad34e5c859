"""DuckDB SQL oracles, one per registered query.

Each query rebuilds the analog inputs of ``sources.analogs`` from the raw
driver tables in plain SQL and then states the operator's contract in SQL.
It shares no code with the Spark side, so agreement is evidence.
"""

from __future__ import annotations

# ------------------------------------------------------------ analog CTEs

PLANNED = r"""
planned_src AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus AS status, o.o_orderpriority AS prio,
         o.o_totalprice, c.c_mktsegment, n.n_nationkey, n.n_name, n.n_regionkey,
         o.o_orderdate + INTERVAL 30 YEAR AS t,
         o.o_orderdate + INTERVAL 30 YEAR + to_minutes(o.o_orderkey % 5) AS t_dp,
         o.o_orderpriority <> '1-URGENT' AS has_ar,
         o.o_orderpriority <> '5-LOW' AS has_dp
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                JOIN nation n ON n.n_nationkey = c.c_nationkey
),
planned_rows AS (
  SELECT t AS snapshot_ts, CAST(t AS DATE) AS snapshot_date,
         CAST(hour(t) AS INTEGER) AS snapshot_hour, CAST(minute(t) AS INTEGER) AS snapshot_minute,
         CAST(o_orderkey AS VARCHAR) AS stop_id,
         CASE o_custkey % 4 WHEN 0 THEN n_name
                            WHEN 1 THEN regexp_replace(n_name, '^NATION_', '')
                            WHEN 2 THEN replace(n_name, '_', ' ')
                            ELSE replace(n_name, '_', '') END AS station_name,
         CAST(n_nationkey AS INTEGER) AS eva_raw,
         status AS filter_flags, substr(prio, 1, 1) AS trip_type,
         CAST(n_regionkey AS VARCHAR) AS owner, c_mktsegment AS trip_category,
         CAST(o_custkey AS VARCHAR) AS train_number,
         CASE WHEN has_ar THEN 'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) END AS origin_station,
         CASE WHEN has_dp THEN 'NATION_' || CAST(o_custkey % 25 AS VARCHAR) END AS destination_station,
         CASE WHEN has_ar THEN t END AS planned_arrival_time,
         CASE WHEN has_dp THEN t_dp END AS planned_departure_time,
         (has_ar AND ((status = 'F' AND prio = '3-MEDIUM') OR (status = 'O' AND prio = '4-NOT SPECIFIED')))
           OR (has_dp AND status = 'P' AND prio = '2-HIGH') AS cancelled,
         CASE WHEN has_dp THEN (CASE WHEN o_totalprice <= 300000 THEN CAST(o_orderkey % 5 + 1 AS VARCHAR) END)
              WHEN has_ar THEN CAST(o_orderkey % 7 + 1 AS VARCHAR) END AS planned_platform
  FROM planned_src
)"""

CHANGES = r"""
change_src AS (
  SELECT l.*, l_shipdate + INTERVAL 30 YEAR AS t,
         l_shipdate + INTERVAL 30 YEAR + to_minutes((8 - l_linenumber) * 17) AS t_dp,
         l_linenumber % 3 <> 0 AND l_quantity >= 10 AS dp_has_ct,
         CASE WHEN l_quantity >= 30 THEN CAST(l_partkey AS VARCHAR) END AS dp_cp
  FROM lineitem l
),
change_rows AS (
  SELECT t AS snapshot_ts, printf('%02d/%012d/%012d', l_linenumber, l_partkey, l_suppkey) AS member,
         CAST(l_orderkey AS VARCHAR) AS stop_id,
         'NATION_' || CAST(l_suppkey % 25 AS VARCHAR) AS station_name,
         CAST(l_suppkey % 25 AS INTEGER) AS eva_raw,
         t AS changed_arrival_time,
         CASE WHEN dp_has_ct THEN t_dp END AS changed_departure_time,
         l_returnflag = 'R' AS cancelled,
         CASE WHEN dp_has_ct THEN dp_cp ELSE CAST(l_suppkey AS VARCHAR) END AS platform_parquet,
         coalesce(CASE WHEN dp_has_ct THEN dp_cp END, CAST(l_suppkey AS VARCHAR)) AS platform_star,
         TRUE AS has_time
  FROM change_src
)"""

STATIONS = r"""
stations AS (
  SELECT CASE n_nationkey % 3 WHEN 0 THEN replace(n_name, '_', '-')
                              WHEN 1 THEN replace(n_name, '_', ' ')
                              ELSE regexp_replace(n_name, '^NATION_', '') END AS name,
         CAST(n_nationkey AS INTEGER) AS eva_number,
         CAST(e.embedding[1] AS DOUBLE) AS longitude,
         CAST(e.embedding[2] AS DOUBLE) AS latitude
  FROM nation n LEFT JOIN embeddings e ON e.vec_id = n.n_nationkey
),
lookup AS (SELECT name, max(eva_number) AS id FROM stations WHERE name IS NOT NULL GROUP BY name)"""


def resolve_cte(name: str, source: str, raw_col: str, lookup: str = "lookup") -> str:
    """CTE ``name(raw, resolved_id)``: first present of four spellings."""
    return f"""
{name} AS (
  SELECT d.raw,
         CASE WHEN l0.name IS NOT NULL THEN l0.id WHEN l1.name IS NOT NULL THEN l1.id
              WHEN l2.name IS NOT NULL THEN l2.id ELSE l3.id END AS resolved_id
  FROM (SELECT DISTINCT {raw_col} AS raw FROM {source} WHERE {raw_col} IS NOT NULL) d
  LEFT JOIN {lookup} l0 ON l0.name = d.raw
  LEFT JOIN {lookup} l1 ON l1.name = regexp_replace(d.raw, '^NATION([- ]?)', '')
  LEFT JOIN {lookup} l2 ON l2.name = 'NATION-' || d.raw
  LEFT JOIN {lookup} l3 ON l3.name = 'NATION ' || d.raw
)"""


def folded_cte(policy: str, rule: str) -> str:
    plat = f"platform_{rule}"
    if policy == "max":
        body = f"""max(changed_arrival_time) AS changed_arrival_time,
         max(changed_departure_time) AS changed_departure_time,
         bool_or(cancelled) AS cancelled, max({plat}) AS changed_platform"""
    else:
        last = lambda c: (f"arg_max({c}, (snapshot_ts, member)) FILTER (WHERE {c} IS NOT NULL)")
        body = f"""{last('changed_arrival_time')} AS changed_arrival_time,
         {last('changed_departure_time')} AS changed_departure_time,
         bool_or(cancelled) AS cancelled, {last(plat)} AS changed_platform"""
    return f"""
folded AS (SELECT stop_id, {body} FROM change_rows GROUP BY stop_id)"""


MOVEMENTS = (PLANNED + "," + CHANGES + "," + STATIONS + "," + resolve_cte("res", "planned_rows", "station_name")
             + "," + folded_cte("max", "parquet") + r""",
movements AS (
  SELECT p.snapshot_date, p.snapshot_hour, p.snapshot_minute, p.stop_id, p.station_name,
         p.filter_flags, p.trip_type, p.owner, r.resolved_id AS eva_number, p.trip_category,
         p.train_number, p.origin_station, p.destination_station,
         p.planned_arrival_time, p.planned_departure_time,
         f.changed_arrival_time, f.changed_departure_time,
         CAST(date_sub('minute', p.planned_arrival_time, f.changed_arrival_time) AS INTEGER) AS arrival_delay_minutes,
         CAST(date_sub('minute', p.planned_departure_time, f.changed_departure_time) AS INTEGER) AS departure_delay_minutes,
         coalesce(p.cancelled, FALSE) OR coalesce(f.cancelled, FALSE) AS cancelled,
         p.planned_platform, f.changed_platform
  FROM planned_rows p LEFT JOIN folded f ON f.stop_id = p.stop_id
                      LEFT JOIN res r ON r.raw = p.station_name
)""")

# ------------------------------------------------------------ queries

SQL: dict[str, str] = {}

SQL["snapshot_parse"] = r"""
WITH m AS (
  SELECT event_id,
         concat_ws('/', CASE WHEN event_type = 'error' THEN 'incoming' ELSE strftime(ts, '%y%m%d%H%M') END,
                   event_type, CAST(event_id AS VARCHAR) || '.xml') AS member
  FROM events),
p AS (SELECT event_id, member,
             try_strptime(nullif(regexp_extract(member, '(\d{10})', 1), ''), '%y%m%d%H%M') AS snapshot_ts
      FROM m)
SELECT event_id, member, snapshot_ts, CAST(snapshot_ts AS DATE) AS snapshot_date,
       CAST(hour(snapshot_ts) AS INTEGER) AS snapshot_hour,
       CAST(minute(snapshot_ts) AS INTEGER) AS snapshot_minute,
       snapshot_ts IS NULL AS quarantined
FROM p"""

HOP_STOPS = r"""
hop AS (
  SELECT '-' || CAST(l_orderkey AS VARCHAR) || '-' || strftime(o_orderdate + INTERVAL 30 YEAR, '%y%m%d%H%M')
         || '-' || CAST(l_linenumber AS VARCHAR) AS stop_id,
         CAST(l_partkey AS VARCHAR) AS station_name
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)"""

SQL["parse_stop_id"] = "WITH " + HOP_STOPS + r"""
SELECT stop_id,
       regexp_extract(stop_id, '^(.*)-(\d+)$', 1) AS trip_key,
       CAST(regexp_extract(stop_id, '^(.*)-(\d+)$', 2) AS BIGINT) AS stop_index,
       strptime(string_split(regexp_replace(stop_id, '^-', ''), '-')[2], '%y%m%d%H%M') AS trip_start
FROM hop"""

SQL["path_ends"] = "WITH " + PLANNED + """
SELECT stop_id, origin_station, destination_station FROM planned_rows"""

SQL["platform_rule"] = "WITH " + PLANNED + "," + CHANGES + """
SELECT 'planned' AS rule, stop_id, '' AS member, planned_platform AS platform FROM planned_rows
UNION ALL SELECT 'parquet', stop_id, member, platform_parquet FROM change_rows
UNION ALL SELECT 'star', stop_id, member, platform_star FROM change_rows"""

SQL["delay_minutes"] = """
WITH s AS (SELECT l_orderkey, max(l_shipdate) AS last_ship, min(l_shipdate) AS first_ship
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey,
       CAST(date_sub('minute', o_orderdate, last_ship) AS INTEGER) AS arrival_delay_minutes,
       CAST(date_sub('minute', o_orderdate, first_ship) AS INTEGER) AS departure_delay_minutes
FROM orders JOIN s ON s.l_orderkey = o_orderkey"""

SQL["fold_changes_max"] = "WITH " + CHANGES + "," + folded_cte("max", "parquet") + """
SELECT * FROM folded"""

SQL["fold_changes_last"] = "WITH " + CHANGES + "," + folded_cte("last", "star") + """
SELECT * FROM folded"""

SQL["merge_movements"] = "WITH " + MOVEMENTS + """
SELECT * FROM movements"""

SQL["daily_avg_delay"] = "WITH " + MOVEMENTS + """,
d AS (SELECT snapshot_date, station_name, arrival_delay_minutes AS delay_minutes FROM movements
      WHERE arrival_delay_minutes IS NOT NULL
      UNION ALL
      SELECT snapshot_date, station_name, departure_delay_minutes FROM movements
      WHERE departure_delay_minutes IS NOT NULL)
SELECT snapshot_date, station_name, avg(delay_minutes) AS avg_delay_minutes
FROM d WHERE station_name = 'NATION 7'
GROUP BY snapshot_date, station_name"""

SQL["delay_unpivot"] = "WITH " + MOVEMENTS + """
SELECT stop_id, 'arrival' AS kind, arrival_delay_minutes AS delay_minutes FROM movements
WHERE arrival_delay_minutes IS NOT NULL
UNION ALL
SELECT stop_id, 'departure', departure_delay_minutes FROM movements
WHERE departure_delay_minutes IS NOT NULL"""

SQL["resolve_name"] = "WITH " + STATIONS + r""",
raw AS (
  SELECT c_custkey,
         CASE c_custkey % 4 WHEN 0 THEN n_name
                            WHEN 1 THEN regexp_replace(n_name, '^NATION_', '')
                            WHEN 2 THEN replace(n_name, '_', ' ')
                            ELSE replace(n_name, '_', '') END AS raw_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey
),""" + resolve_cte("res", "raw", "raw_name") + """
SELECT c_custkey, raw_name, r.resolved_id FROM raw LEFT JOIN res r ON r.raw = raw.raw_name"""


SQL["xml_planned"] = "WITH " + PLANNED + """
SELECT stop_id, station_name, eva_raw, snapshot_ts, filter_flags, trip_type, owner, trip_category,
       train_number, origin_station, destination_station, planned_arrival_time,
       planned_departure_time, cancelled, planned_platform
FROM planned_rows"""

SQL["xml_changes"] = "WITH " + CHANGES + """
SELECT stop_id, station_name, eva_raw, snapshot_ts, changed_arrival_time, changed_departure_time,
       cancelled, platform_star AS changed_platform, has_time
FROM change_rows"""

SQL["dim_station"] = "WITH " + STATIONS + """
SELECT row_number() OVER (ORDER BY eva_number NULLS FIRST, name NULLS FIRST) AS station_id,
       name, eva_number, longitude, latitude
FROM stations"""

SQL["dim_date"] = """
SELECT row_number() OVER (ORDER BY date) AS date_id, date
FROM (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE ts IS NOT NULL)"""

SQL["dim_time"] = """
SELECT row_number() OVER (ORDER BY time) AS time_id, time
FROM (SELECT DISTINCT strftime(ts, '%H:%M:%S') AS time FROM events WHERE ts IS NOT NULL)"""

TRAIN_KEY = ["filter_flags", "trip_type", "owner", "trip_category", "train_number",
             "origin_station", "destination_station"]
_TRAIN_ORDER = ", ".join(f"{c} NULLS FIRST" for c in TRAIN_KEY)

DIM_TRAIN = f"""
dtrain AS (
  SELECT row_number() OVER (ORDER BY {_TRAIN_ORDER}) AS train_id, *
  FROM (SELECT DISTINCT {", ".join(TRAIN_KEY)} FROM planned_rows)
)"""

SQL["dim_train"] = "WITH " + PLANNED + "," + DIM_TRAIN + """
SELECT * FROM dtrain"""

SQL["fact_first_wins"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
                                        l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem)
WHERE rn = 1"""

SQL["upsert_last"] = "WITH " + PLANNED + "," + CHANGES + "," + folded_cte("last", "star") + """
SELECT p.stop_id, p.planned_arrival_time, p.planned_departure_time,
       f.changed_arrival_time, f.changed_departure_time,
       CAST(date_sub('minute', p.planned_arrival_time, f.changed_arrival_time) AS INTEGER) AS arrival_delay_minutes,
       CAST(date_sub('minute', p.planned_departure_time, f.changed_departure_time) AS INTEGER) AS departure_delay_minutes,
       coalesce(p.cancelled, FALSE) OR coalesce(f.cancelled, FALSE) AS cancelled,
       p.planned_platform, f.changed_platform
FROM planned_rows p LEFT JOIN folded f ON f.stop_id = p.stop_id"""

SQL["unmatched_changes"] = "WITH " + PLANNED + "," + CHANGES + """
SELECT c.stop_id, c.station_name, c.eva_raw AS eva_number, c.snapshot_ts, c.changed_arrival_time,
       c.changed_departure_time, c.cancelled, c.platform_star AS changed_platform, c.has_time
FROM change_rows c
WHERE NOT EXISTS (SELECT 1 FROM planned_rows p WHERE p.stop_id = c.stop_id AND p.filter_flags <> 'P')"""

STAR = (PLANNED + "," + CHANGES + "," + STATIONS + "," + folded_cte("last", "star") + "," + DIM_TRAIN + """,
dstation AS (SELECT row_number() OVER (ORDER BY eva_number NULLS FIRST, name NULLS FIRST) AS station_id, name
             FROM stations),
slookup AS (SELECT name, max(station_id) AS id FROM dstation WHERE name IS NOT NULL GROUP BY name),
ddate AS (SELECT row_number() OVER (ORDER BY date) AS date_id, date
          FROM (SELECT DISTINCT CAST(snapshot_ts AS DATE) AS date FROM planned_rows)),
dtime AS (SELECT row_number() OVER (ORDER BY time) AS time_id, time
          FROM (SELECT DISTINCT strftime(snapshot_ts, '%H:%M:%S') AS time FROM planned_rows)),"""
        + resolve_cte("sres", "planned_rows", "station_name", "slookup") + """,
fact AS (
  SELECT p.stop_id, r.resolved_id AS station_id, t.train_id, dd.date_id, dt.time_id,
         p.planned_arrival_time, p.planned_departure_time, f.changed_arrival_time, f.changed_departure_time,
         CAST(date_sub('minute', p.planned_arrival_time, f.changed_arrival_time) AS INTEGER) AS arrival_delay_minutes,
         CAST(date_sub('minute', p.planned_departure_time, f.changed_departure_time) AS INTEGER) AS departure_delay_minutes,
         coalesce(p.cancelled, FALSE) OR coalesce(f.cancelled, FALSE) AS cancelled,
         p.planned_platform, f.changed_platform
  FROM planned_rows p
  LEFT JOIN sres r ON r.raw = p.station_name
  LEFT JOIN dtrain t ON """ + " AND ".join(f"t.{c} IS NOT DISTINCT FROM p.{c}" for c in TRAIN_KEY) + """
  LEFT JOIN ddate dd ON dd.date = CAST(p.snapshot_ts AS DATE)
  LEFT JOIN dtime dt ON dt.time = strftime(p.snapshot_ts, '%H:%M:%S')
  LEFT JOIN folded f ON f.stop_id = p.stop_id
)""")

SQL["star_fact"] = "WITH " + STAR + """
SELECT * FROM fact"""

SQL["station_by_name"] = "WITH " + STATIONS + "," + resolve_cte("one", "(SELECT 'NATION 5' AS raw_name)", "raw_name") + """
SELECT s.name, s.longitude, s.latitude, s.eva_number AS identifier
FROM one JOIN stations s ON s.eva_number = one.resolved_id AND s.name IN
     (SELECT name FROM stations WHERE eva_number = one.resolved_id)"""

SQL["avg_delay"] = "WITH " + STAR + "," + resolve_cte("one", "(SELECT '7' AS raw_name)", "raw_name", "slookup") + """
SELECT avg(d) AS avg_delay_minutes FROM (
  SELECT arrival_delay_minutes AS d FROM fact
  WHERE station_id = (SELECT resolved_id FROM one) AND arrival_delay_minutes IS NOT NULL
  UNION ALL
  SELECT departure_delay_minutes FROM fact
  WHERE station_id = (SELECT resolved_id FROM one) AND departure_delay_minutes IS NOT NULL)"""

SQL["peak_departures"] = """
WITH t AS (SELECT CAST(user_id AS VARCHAR) AS station_name, ts AS planned_departure_time,
                  CAST(ts AS DATE) AS snapshot_date FROM events),
cnt AS (SELECT station_name, snapshot_date, count(*) AS n FROM t
        WHERE planned_departure_time IS NOT NULL
          AND ((hour(planned_departure_time) >= 7 AND hour(planned_departure_time) < 9)
               OR (hour(planned_departure_time) >= 17 AND hour(planned_departure_time) < 19))
        GROUP BY station_name, snapshot_date),
grid AS (SELECT s.station_name, d.snapshot_date
         FROM (SELECT DISTINCT station_name FROM t) s CROSS JOIN (SELECT DISTINCT snapshot_date FROM t) d)
SELECT g.station_name, avg(coalesce(c.n, 0)) AS avg_num_train_departures_during_peak
FROM grid g LEFT JOIN cnt c ON c.station_name = g.station_name AND c.snapshot_date = g.snapshot_date
GROUP BY g.station_name"""

SQL["cancelled_at"] = """
SELECT count(*) AS cancelled_movements FROM events
WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15' AND hour(ts) = 15"""

SQL["nearest_station"] = """
WITH p AS (SELECT 'S' || CAST(vec_id AS VARCHAR) AS name, CAST(embedding[2] AS DOUBLE) AS latitude,
                  CAST(embedding[1] AS DOUBLE) AS longitude FROM embeddings)
SELECT name, latitude, longitude FROM p
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
ORDER BY sqrt(power(latitude - 0.0, 2) + power(longitude - 0.0, 2)), name
LIMIT 1"""

SQL["nearest_station_batch"] = "WITH " + STATIONS + """,
q AS (SELECT vec_id AS point_id, CAST(embedding[4] AS DOUBLE) AS latitude,
             CAST(embedding[3] AS DOUBLE) AS longitude FROM embeddings)
SELECT q.point_id,
       arg_min(s.name, (sqrt(power(s.latitude - q.latitude, 2) + power(s.longitude - q.longitude, 2)), s.name)) AS name
FROM q, stations s
WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL AND q.latitude IS NOT NULL AND q.longitude IS NOT NULL
GROUP BY q.point_id"""

EDGES = HOP_STOPS + r""",
hs AS (SELECT regexp_extract(stop_id, '^(.*)-(\d+)$', 1) AS trip_key,
              CAST(regexp_extract(stop_id, '^(.*)-(\d+)$', 2) AS BIGINT) AS stop_index, min(station_name) AS station_name
       FROM hop WHERE stop_id IS NOT NULL AND station_name IS NOT NULL GROUP BY ALL),
hn AS (SELECT station_name AS src,
              lead(station_name) OVER (PARTITION BY trip_key ORDER BY stop_index, station_name) AS dst
       FROM hs),
edges AS (SELECT DISTINCT src, dst FROM hn WHERE dst IS NOT NULL AND src <> dst)"""

SQL["trip_edges"] = "WITH " + EDGES + """
SELECT src, dst FROM edges"""

CONNS = r"""
tm AS (SELECT 'u' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS stop_id,
              json_extract_string(props, '$.k') AS station_name, ts AS ar, ts AS dp FROM events),
ts_ AS (SELECT DISTINCT regexp_extract(stop_id, '^(.*)-(\d+)$', 1) AS trip_key,
               CAST(regexp_extract(stop_id, '^(.*)-(\d+)$', 2) AS BIGINT) AS stop_index, station_name, ar, dp
        FROM tm WHERE stop_id IS NOT NULL AND station_name IS NOT NULL),
tn AS (SELECT station_name AS src, lead(station_name) OVER w AS dst, dp AS dp_time,
              lead(ar) OVER w AS ar_time, trip_key
       FROM ts_
       WINDOW w AS (PARTITION BY trip_key ORDER BY stop_index NULLS FIRST, station_name NULLS FIRST,
                                                   ar NULLS FIRST, dp NULLS FIRST)),
tc AS (SELECT src, dst, dp_time, ar_time, trip_key FROM tn
       WHERE dst IS NOT NULL AND src <> dst AND dp_time IS NOT NULL AND ar_time IS NOT NULL
         AND ar_time >= dp_time)"""

SQL["timed_connections"] = "WITH " + CONNS + """
SELECT * FROM tc"""

SQL["edge_connections"] = "WITH " + CONNS + """
SELECT src, dst, date_trunc('hour', dp_time) AS period, count(*) AS n_connections,
       string_agg(strftime(dp_time, '%Y-%m-%d %H:%M:%S.%f') || '|' || strftime(ar_time, '%Y-%m-%d %H:%M:%S.%f')
                  || '|' || trip_key, ';' ORDER BY dp_time, ar_time, trip_key) AS connections
FROM tc GROUP BY src, dst, date_trunc('hour', dp_time)"""

SQL["edge_lists"] = "WITH " + CONNS + """,
numbered AS (SELECT *, (row_number() OVER (PARTITION BY src, dst ORDER BY dp_time, ar_time, trip_key) - 1) // 4 AS page FROM tc)
SELECT src, dst, page, count(*) AS n_connections,
       string_agg(strftime(dp_time, '%Y-%m-%d %H:%M:%S.%f') || '|' || strftime(ar_time, '%Y-%m-%d %H:%M:%S.%f')
                  || '|' || trip_key, ';' ORDER BY dp_time, ar_time, trip_key) AS connections
FROM numbered GROUP BY src, dst, page"""

SQL["shortest_path"] = "WITH RECURSIVE " + EDGES + """,
bfs(station_name, hops, path) USING KEY (station_name) AS (
  SELECT DISTINCT '0', 0, ['0'] FROM edges WHERE src = '0' OR dst = '0'
  UNION
  SELECT e.dst, min(b.hops) + 1, min(b.path || [e.dst])
  FROM bfs b JOIN edges e ON e.src = b.station_name
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.station_name = e.dst)
  GROUP BY e.dst)
SELECT station_name, CAST(hops AS INTEGER) AS hops, array_to_string(path, '>') AS path FROM bfs"""

SQL["earliest_arrival"] = "WITH RECURSIVE " + CONNS + """,
c AS (SELECT * FROM tc WHERE dp_time >= TIMESTAMP '2024-01-01 00:00:00'),
ea(station_name, earliest_arrival) USING KEY (station_name) AS (
  SELECT DISTINCT '0', TIMESTAMP '2024-01-01 00:00:00' FROM tc WHERE src = '0' OR dst = '0'
  UNION
  SELECT c.dst, min(c.ar_time) FROM ea r JOIN c ON c.src = r.station_name AND c.dp_time >= r.earliest_arrival
  WHERE NOT EXISTS (SELECT 1 FROM recurring.ea x WHERE x.station_name = c.dst AND x.earliest_arrival <= c.ar_time)
  GROUP BY c.dst)
SELECT station_name, earliest_arrival FROM ea"""

# round by round: of the rides that improve a station the least (arrival, departure, from, trip)
SQL["earliest_arrival_path"] = "WITH RECURSIVE " + CONNS + """,
c AS (SELECT * FROM tc WHERE dp_time >= TIMESTAMP '2024-01-01 00:00:00'),
ea(station_name, earliest_arrival, prev) USING KEY (station_name) AS (
  SELECT DISTINCT '0', TIMESTAMP '2024-01-01 00:00:00', CAST(NULL AS VARCHAR) FROM tc WHERE src = '0' OR dst = '0'
  UNION
  SELECT c.dst, min(c.ar_time), arg_min(c.src, (c.ar_time, c.dp_time, c.src, c.trip_key))
  FROM ea r JOIN c ON c.src = r.station_name AND c.dp_time >= r.earliest_arrival
  WHERE NOT EXISTS (SELECT 1 FROM recurring.ea x WHERE x.station_name = c.dst AND x.earliest_arrival <= c.ar_time)
  GROUP BY c.dst),
walk(target, earliest_arrival, here, path) AS (
  SELECT station_name, earliest_arrival, prev, station_name FROM ea
  UNION ALL
  SELECT w.target, w.earliest_arrival, e.prev, e.station_name || '>' || w.path FROM walk w JOIN ea e ON e.station_name = w.here)
SELECT target AS station_name, earliest_arrival, path FROM walk WHERE here IS NULL"""

SQL["earliest_arrival_all"] = "WITH RECURSIVE " + CONNS + """,
c AS (SELECT * FROM tc WHERE dp_time >= TIMESTAMP '2024-01-01 00:00:00'),
ea(source, station_name, earliest_arrival) USING KEY (source, station_name) AS (
  SELECT DISTINCT src, src, TIMESTAMP '2024-01-01 00:00:00' FROM tc
  UNION
  SELECT r.source, c.dst, min(c.ar_time)
  FROM ea r JOIN c ON c.src = r.station_name AND c.dp_time >= r.earliest_arrival
  WHERE NOT EXISTS (SELECT 1 FROM recurring.ea x
                    WHERE x.source = r.source AND x.station_name = c.dst AND x.earliest_arrival <= c.ar_time)
  GROUP BY r.source, c.dst)
SELECT source, station_name, earliest_arrival FROM ea"""

# ------------------------------------------------- two loads that share a day

SQL["incremental_movements"] = SQL["merge_movements"]

SQL["incremental_star"] = "WITH " + STAR + """
SELECT f.* EXCLUDE (train_id, date_id, time_id), t.* EXCLUDE (train_id), dd.date, dt.time
FROM fact f LEFT JOIN dtrain t USING (train_id) LEFT JOIN ddate dd USING (date_id) LEFT JOIN dtime dt USING (time_id)"""

SQL["stable_dim_keys"] = """
WITH starts AS (SELECT o_orderdate + INTERVAL 30 YEAR AS t FROM orders),
seen AS (
  SELECT 'date' AS dim, CAST(CAST(t AS DATE) AS VARCHAR) AS member, CAST(t AS DATE) <= DATE '2028-06-15' AS early FROM starts
  UNION ALL
  SELECT 'time', strftime(t, '%H:%M:%S'), CAST(t AS DATE) <= DATE '2028-06-15' FROM starts
), members AS (SELECT dim, member, bool_or(early) AS early FROM seen WHERE member IS NOT NULL GROUP BY dim, member)
SELECT dim, member, row_number() OVER (PARTITION BY dim ORDER BY early DESC, member) AS id FROM members"""

SQL["shortest_path_target"] = SQL["shortest_path"] + """ WHERE station_name = '7'"""
