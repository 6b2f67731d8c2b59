"""SQL fragments shared by the checks (DuckDB dialect)."""

from __future__ import annotations

DAY = 86_400_000_000
HOUR = 3_600_000_000
SECOND = 1_000_000

LOCATION = ("('47.' || lpad(CAST(370000 + (c_custkey * 37) % 9000 AS VARCHAR), 6, '0')"
            " || ',8.' || lpad(CAST(510000 + (c_custkey * 53) % 20000 AS VARCHAR), 6, '0'))")


def latitude(text: str) -> str:
    return f"CAST(nullif(regexp_extract({text}, '^(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)"


def longitude(text: str) -> str:
    return f"CAST(nullif(regexp_extract({text}, '(-?\\d+(?:\\.\\d+)?)$', 1), '') AS DOUBLE)"


POSITIONS = (f"SELECT c_custkey AS id, {latitude(LOCATION)} AS lat, "
             f"{longitude(LOCATION)} AS lon FROM customer")

# The event time as it is after a trip through millisecond text.
MILLIS = "date_trunc('milliseconds', ts)"
ISO_MILLIS = "(strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')"

ENRICHED = f"""
    SELECT CAST(user_id AS VARCHAR) AS "deviceId", c_mktsegment AS "deviceCity",
           CAST(c_nationkey AS VARCHAR) AS "deviceRegion", {LOCATION} AS "deviceLocation",
           'operatingNotification' AS "messageName", event_type AS "eventNotificationName",
           {MILLIS} AS "timestamp", {ISO_MILLIS} AS "eventTimestamp"
    FROM events JOIN customer ON user_id = c_custkey"""


def hops(size: int, slide: int, keys: str, where: str = "TRUE", source: str = "events",
         time: str = "ts") -> str:
    """Counts per sliding window and keys."""
    start = f"(epoch_us({time}) // {slide} - i) * {slide}"
    return f"""
        SELECT make_timestamp({start}) AS window_start,
               make_timestamp({start} + {size}) AS window_end, {keys},
               count(*) AS total_count
        FROM {source}, range({size // slide}) AS r(i)
        WHERE {where}
        GROUP BY ALL"""


def alerts(size: int, slide: int, k: float, floor: float, keys: str = "user_id",
           where: str = "event_type = 'error'", integer_stats: bool = True,
           source: str = "events", time: str = "ts", last: str = "TRUE") -> str:
    """Rows above mean + k deviations + floor of their window."""
    mean, deviation = "avg(total_count)", "stddev_samp(total_count)"
    if integer_stats:
        # Rounded first: a deviation of exactly 2 may come out as 1.999...
        mean = f"CAST(trunc({mean}) AS BIGINT)"
        deviation = f"CAST(trunc(round({deviation}, 9)) AS BIGINT)"
        shown = "avg_error_count, std_error_count"
    else:
        shown = ("round(avg_error_count, 6) AS avg_error_count, "
                 "round(std_error_count, 6) AS std_error_count")
    return f"""
        WITH a AS ({hops(size, slide, keys, where, source, time)}),
        b AS (SELECT window_start, {mean} AS avg_error_count, {deviation} AS std_error_count
              FROM a GROUP BY window_start)
        SELECT a.window_start, a.window_end, total_count AS total_count_per_deviceid,
               {keys}, {shown}
        FROM a JOIN b ON a.window_start = b.window_start
        WHERE total_count > avg_error_count + {k} * std_error_count + {floor} AND {last}"""


CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)"

LAND = """
    SELECT s_suppkey AS polygon_id,
           ['commercial', 'forest', 'industrial', 'residential'][s_nationkey % 4 + 1] AS landuse,
           v.no AS vertex_no,
           47.37 + (s_suppkey * 41 % 9000) / 1e6 + v.dy AS lat,
           8.51 + (s_suppkey * 59 % 20000) / 1e6 + v.dx AS lon
    FROM supplier, (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, 0.0, 0.0021), (2, 0.0013, 0.0023),
                           (3, 0.0004, 0.0011), (4, 0.0012, 0.0002)) AS v(no, dy, dx)"""

LAND_WITH_HOLES = f"""
    SELECT polygon_id, landuse, 0 AS ring_no,
           CASE WHEN polygon_id % 7 = 0 AND vertex_no IN (1, 2) THEN 3 - vertex_no ELSE vertex_no END AS vertex_no,
           lat, lon
    FROM ({LAND})
    UNION ALL SELECT polygon_id, landuse, 0, 5, lat, lon FROM ({LAND}) WHERE polygon_id % 11 = 0 AND vertex_no = 4
    UNION ALL
    SELECT s_suppkey, 'hole', 1, v.no, 47.37 + (s_suppkey * 41 % 9000) / 1e6 + v.dy,
           8.51 + (s_suppkey * 59 % 20000) / 1e6 + v.dx + CASE WHEN s_suppkey % 9 = 0 THEN 0.01 ELSE 0.0 END
    FROM supplier, (VALUES (0, 0.0001::DOUBLE, 0.0006::DOUBLE), (1, 0.0001, 0.0009), (2, 0.0002, 0.0009),
                           (3, 0.0003, 0.0007)) AS v(no, dy, dx)
    WHERE s_suppkey % 3 = 0"""

CITY = f"""
    SELECT 0 AS polygon_id, 'city' AS landuse, v.no AS vertex_no,
           s + (n - s) * v.dy AS lat, w + (e - w) * v.dx AS lon
    FROM (SELECT min(lat) AS s, max(lat) AS n, min(lon) AS w, max(lon) AS e FROM ({POSITIONS})),
         (VALUES (0, 0.25::DOUBLE, 0.4::DOUBLE), (1, 0.25, 0.6), (2, 0.4, 0.75), (3, 0.6, 0.75),
                 (4, 0.75, 0.6), (5, 0.75, 0.4), (6, 0.6, 0.25), (7, 0.4, 0.25)) AS v(no, dy, dx)"""


def edges(vertices: str) -> str:
    """Sides of rings, those that close them too."""
    return f"""
        SELECT polygon_id, ring_no, row_number() OVER w - 1 AS edge_no,
               count(*) OVER (PARTITION BY polygon_id, ring_no) AS edges, lat AS lat1, lon AS lon1,
               coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS lat2,
               coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS lon2
        FROM ({vertices}) WINDOW w AS (PARTITION BY polygon_id, ring_no ORDER BY vertex_no)"""


def inside_rings(points: str, vertices: str) -> str:
    """``lat, lon, polygon_id`` by ray crossing against every side of every ring."""
    return f"""
        SELECT p.lat, p.lon, e.polygon_id
        FROM (SELECT DISTINCT lat, lon FROM ({points})) p
        JOIN ({edges(vertices)}) e
          ON (lat1 > lat) <> (lat2 > lat)
             AND lon < (lon2 - lon1) * (lat - lat1) / (lat2 - lat1) + lon1
        GROUP BY ALL HAVING count(*) % 2 = 1"""


def invalid(vertices: str) -> str:
    """``polygon_id, reason`` by comparing every two sides of a polygon; sides of these
    shapes never lie on one line but as neighbours that go on."""
    turn = ("sign(({b}.lon2 - {b}.lon1) * ({a}.lat{n} - {b}.lat1)"
            " - ({b}.lat2 - {b}.lat1) * ({a}.lon{n} - {b}.lon1))")
    t = [turn.format(a=a, b=b, n=n) for a, b in ("ab", "ba") for n in (1, 2)]
    crosses = f"{t[0]} * {t[1]} < 0 AND {t[2]} * {t[3]} < 0"
    return f"""
        WITH e AS ({edges(vertices)}),
        crossing AS (
            SELECT DISTINCT a.polygon_id FROM e a JOIN e b
            ON a.polygon_id = b.polygon_id AND (a.ring_no, a.edge_no) < (b.ring_no, b.edge_no)
            WHERE {crosses} AND (a.ring_no <> b.ring_no
                OR (b.edge_no - a.edge_no <> 1 AND b.edge_no - a.edge_no <> a.edges - 1))),
        outside AS (
            SELECT h.polygon_id, h.lat1, h.lon1, count(o.polygon_id) % 2 AS n
            FROM e h LEFT JOIN e o ON o.polygon_id = h.polygon_id AND o.ring_no = 0
                AND (o.lat1 > h.lat1) <> (o.lat2 > h.lat1)
                AND h.lon1 < (o.lon2 - o.lon1) * (h.lat1 - o.lat1) / (o.lat2 - o.lat1) + o.lon1
            WHERE h.ring_no = 1 GROUP BY ALL)
        SELECT polygon_id, min(reason) AS reason FROM (
            SELECT polygon_id, '1 repeated' AS reason FROM e WHERE lat1 = lat2 AND lon1 = lon2
            UNION ALL SELECT polygon_id, '2 crossing' FROM crossing
            UNION ALL SELECT polygon_id, '3 hole' FROM outside GROUP BY polygon_id HAVING max(n) = 0)
        GROUP BY polygon_id"""


def inside(points: str, vertices: str) -> str:
    """``lat, lon, polygon_id`` by ray crossing against every edge."""
    return f"""
        SELECT p.lat, p.lon, e.polygon_id
        FROM (SELECT DISTINCT lat, lon FROM ({points})) p
        JOIN (SELECT polygon_id, lat AS lat1, lon AS lon1,
                     coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS lat2,
                     coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS lon2
              FROM ({vertices})
              WINDOW w AS (PARTITION BY polygon_id ORDER BY vertex_no)) e
          ON (lat1 > lat) <> (lat2 > lat)
             AND lon < (lon2 - lon1) * (lat - lat1) / (lat2 - lat1) + lon1
        GROUP BY ALL HAVING count(*) % 2 = 1"""
