"""DuckDB SQL for the registered queries, in the plainest form of each definition.

Written from the definitions and not from the Spark code: nearest city is a join with every
city and a row number, pairs are a self join, proximity compares all points of both users.
"""

from __future__ import annotations

from waymark.sources.cities import AREA_ZONES, CITIES

_CITY_ROWS = ", ".join(f"({i}, '{city}', {lat}, {lon})" for i, city, lat, lon in CITIES)
_ZONE_ROWS = ", ".join(f"('{name}')" for name in AREA_ZONES)


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"2 * 6371.0 * atan2(sqrt({a}), sqrt(1 - {a}))"


def _planar(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"sqrt(({lat1} - {lat2}) * ({lat1} - {lat2}) + ({lon1} - {lon2}) * ({lon1} - {lon2})) * 111"
    )


# Each step: name, steps it reads, SQL.
_STEPS = {
    "city": ((), f"SELECT * FROM (VALUES {_CITY_ROWS}) AS v(id, city, lat, lon)"),
    "zone": ((), f"SELECT * FROM (VALUES {_ZONE_ROWS}) AS v(name)"),
    "city_dim": (
        ("city", "zone"),
        """
        SELECT id, city, lat, lon,
               coalesce('Australia/' || zone.name, 'Australia/Sydney') AS timezone
        FROM city LEFT JOIN zone ON zone.name = city.city
        """,
    ),
    "geo": (
        ("city",),
        """
        SELECT g.event_id, g.ts, g.user_id, g.date, g.event_type, g.channel, g.message_to,
               c.lat + g.dlat AS lat, c.lon + g.dlon AS lon
        FROM (
          SELECT event_id, ts, user_id, CAST(ts AS DATE) AS date,
            CASE event_type WHEN 'click' THEN 'reaction' WHEN 'purchase' THEN 'subscription'
                            ELSE 'message' END AS event_type,
            CASE WHEN event_type = 'purchase' THEN event_id % 5 END AS channel,
            CASE WHEN event_id % 30 = 0 AND event_type NOT IN ('click', 'purchase')
                 THEN user_id - user_id % 15 + (user_id * 7 + event_id) % 15 END AS message_to,
            1 + (CASE WHEN (dayofyear(CAST(ts AS DATE)) + user_id) % 10 >= 7
                      THEN user_id + 3 ELSE user_id END) % 6 AS cid,
            ((event_id * 7919) % 1001 - 500) / CAST(1000 AS DOUBLE) AS dlat,
            ((event_id * 104729) % 1009 - 504) / CAST(1000 AS DOUBLE) AS dlon
          FROM events) g
        JOIN city c ON c.id = g.cid
        """,
    ),
    "matched": (
        ("geo", "city"),
        f"""
        SELECT message_id, user_id, datetime, city, lat, lon, date, km FROM (
          SELECT *, row_number() OVER (
                      PARTITION BY message_id, user_id, datetime ORDER BY km, city, lat, lon
                    ) AS place
          FROM (
            SELECT g.event_id AS message_id, g.user_id, g.ts AS datetime, c.city, g.lat, g.lon,
                   g.date, {_haversine('g.lat', 'g.lon', 'c.lat', 'c.lon')} AS km
            FROM geo g, city c WHERE g.event_type = 'message'))
        WHERE place = 1
        """,
    ),
    "presence": (
        ("matched",),
        """
        SELECT user_id, city, date, max(datetime) AS datetime
        FROM matched GROUP BY user_id, city, date
        """,
    ),
    "streaks": (
        ("presence",),
        """
        SELECT user_id, city, min(date) AS first_date, max(date) AS last_date,
               max(datetime) AS last_action, count(*) AS days
        FROM (SELECT *, date - CAST(row_number() OVER (
                          PARTITION BY user_id, city ORDER BY date) AS INTEGER) AS island
              FROM presence)
        GROUP BY user_id, city, island
        """,
    ),
    "home": (
        ("streaks",),
        """
        SELECT u.user_id, coalesce(l.city, t.city) AS home_city
        FROM (SELECT DISTINCT user_id FROM streaks) u
        LEFT JOIN (
          SELECT user_id, city, row_number() OVER (
              PARTITION BY user_id ORDER BY last_date DESC, last_action DESC, city DESC) AS place
          FROM streaks WHERE days >= 4) l ON l.user_id = u.user_id AND l.place = 1
        LEFT JOIN (
          SELECT user_id, city, row_number() OVER (
              PARTITION BY user_id ORDER BY total DESC, latest DESC, city DESC) AS place
          FROM (SELECT user_id, city, sum(days) AS total, max(last_action) AS latest
                FROM streaks GROUP BY user_id, city)) t ON t.user_id = u.user_id AND t.place = 1
        """,
    ),
    "current_place": (
        ("streaks",),
        """
        SELECT s.user_id, s.city AS act_city, a.latest, a.earliest
        FROM (SELECT user_id, city, row_number() OVER (
                PARTITION BY user_id ORDER BY last_date DESC, last_action DESC, city DESC) AS place
              FROM streaks) s
        JOIN (SELECT user_id, max(last_action) AS latest, min(last_action) AS earliest
              FROM streaks GROUP BY user_id) a ON a.user_id = s.user_id
        WHERE s.place = 1
        """,
    ),
    "travel": (
        ("streaks",),
        """
        SELECT user_id, count(*) AS travel_count,
               string_agg(city, ',' ORDER BY last_date, last_action, city) AS travel_array
        FROM (SELECT *, lag(city) OVER (
                PARTITION BY user_id ORDER BY last_date, last_action, city) AS city_before
              FROM streaks)
        WHERE city_before IS NULL OR city_before <> city
        GROUP BY user_id
        """,
    ),
    "users": (
        ("home", "current_place", "travel", "city_dim"),
        """
        SELECT h.user_id, h.home_city, t.travel_count, t.travel_array,
               timezone(c.timezone, timezone('UTC', p.latest)) AS local_time, p.act_city
        FROM home h
        JOIN current_place p ON p.user_id = h.user_id
        JOIN travel t ON t.user_id = h.user_id
        JOIN city_dim c ON c.city = p.act_city
        """,
    ),
    "placed": (
        ("geo", "users"),
        """
        SELECT g.event_id AS message_id, g.user_id, g.event_type, g.date,
               CAST(g.date - CAST(dayofweek(g.date) AS INTEGER) AS DATE) AS week,
               CAST(date_trunc('month', g.date) AS DATE) AS month, u.act_city AS city
        FROM geo g JOIN users u ON u.user_id = g.user_id
        """,
    ),
    "regs": (
        ("matched", "users"),
        """
        SELECT city, CAST(reg_date - CAST(dayofweek(reg_date) AS INTEGER) AS DATE) AS week,
               CAST(date_trunc('month', reg_date) AS DATE) AS month,
               count(DISTINCT user_id) AS users
        FROM (SELECT m.city, m.user_id, min(m.date) AS reg_date
              FROM matched m JOIN users u ON u.user_id = m.user_id AND u.act_city = m.city
              GROUP BY m.city, m.user_id)
        GROUP BY ALL
        """,
    ),
    "week_counts": (
        ("placed",),
        """
        SELECT city, week, month,
          nullif(count(*) FILTER (event_type = 'message'), 0) AS week_message,
          nullif(count(*) FILTER (event_type = 'reaction'), 0) AS week_reaction,
          nullif(count(*) FILTER (event_type = 'subscription'), 0) AS week_subscription
        FROM placed GROUP BY city, week, month
        """,
    ),
    "month_counts": (
        ("placed",),
        """
        SELECT city, month,
          nullif(count(*) FILTER (event_type = 'message'), 0) AS month_message,
          nullif(count(*) FILTER (event_type = 'reaction'), 0) AS month_reaction,
          nullif(count(*) FILTER (event_type = 'subscription'), 0) AS month_subscription
        FROM placed GROUP BY city, month
        """,
    ),
    "interests": (
        ("geo", "users"),
        """
        SELECT DISTINCT g.user_id, g.channel, u.home_city AS city
        FROM geo g JOIN users u ON u.user_id = g.user_id WHERE g.event_type = 'subscription'
        """,
    ),
    "pairs": (
        ("interests",),
        """
        SELECT DISTINCT a.user_id AS user_left, b.user_id AS user_right, a.city
        FROM interests a
        JOIN interests b ON a.channel = b.channel AND a.city = b.city AND a.user_id > b.user_id
        """,
    ),
    "wrote": (
        ("geo",),
        """
        SELECT DISTINCT user_id, message_to AS contact_id
        FROM geo WHERE event_type = 'message' AND message_to > 0
        """,
    ),
    "edges": (
        ("wrote",),
        "SELECT * FROM wrote UNION SELECT contact_id AS user_id, user_id AS contact_id FROM wrote",
    ),
    "strangers": (
        ("pairs", "edges"),
        """
        SELECT * FROM pairs p WHERE NOT EXISTS (
          SELECT 1 FROM edges e WHERE e.user_id = p.user_left AND e.contact_id = p.user_right)
        """,
    ),
    "spots": (
        ("matched",),
        "SELECT DISTINCT user_id, lat, lon FROM matched",
    ),
}


def _near(pairs: str, km: str, distance=_planar) -> str:
    return f"""
        SELECT p.* FROM {pairs} p WHERE EXISTS (
          SELECT 1 FROM spots a, spots b
          WHERE a.user_id = p.user_left AND b.user_id = p.user_right
            AND {distance('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= {km})
    """


_STEPS["wrote_pairs"] = (
    ("edges",),
    "SELECT user_id AS user_left, contact_id AS user_right FROM edges WHERE user_id >= contact_id",
)
_STEPS["near_interest"] = (("pairs", "spots"), _near("pairs", "1.0"))
_STEPS["near_strangers"] = (("strangers", "spots"), _near("strangers", "1.0"))


def _with(final: str, *needs: str) -> str:
    """``final`` after the steps it needs, each once and in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in _STEPS[name][0]:
                visit(other)
            order.append(name)

    for name in needs:
        visit(name)
    steps = ",\n".join(f"{name} AS ({_STEPS[name][1]})" for name in order)
    return f"WITH {steps}\n{final}" if steps else final


_TEXT_VARIANTS = """
    SELECT event_id, CAST(ts AS DATE) AS day, ts,
      CASE event_id % 5
        WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '000'
        WHEN 1 THEN left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 21)
        WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        WHEN 3 THEN 'at ' || strftime(ts, '%H:%M') END AS v
    FROM events
"""

ORACLES: dict[str, str] = {
    "haversine_to_city": _with(
        f"SELECT event_id, round({_haversine('lat', 'lon', '-33.865', '151.2094')}, 6) AS km FROM geo",
        "geo",
    ),
    "planar_distance": _with(
        f"SELECT event_id, round({_planar('lat', 'lon', '-33.865', '151.2094')}, 6) AS km FROM geo",
        "geo",
    ),
    "nearest_city": _with(
        """SELECT message_id, user_id, datetime, city, round(lat, 6) AS lat, round(lon, 6) AS lon,
                  date, round(km, 6) AS km FROM matched""",
        "matched",
    ),
    "messages_per_city_day": _with(
        "SELECT city, date, count(*) AS messages FROM matched GROUP BY city, date", "matched"
    ),
    "city_timezone": _with(
        """SELECT m.city, m.messages, c.timezone
           FROM (SELECT city, count(*) AS messages FROM matched GROUP BY city) m
           JOIN city_dim c ON c.city = m.city""",
        "matched",
        "city_dim",
    ),
    "parse_city_csv": _with(
        """SELECT l.id, l.city, CAST(replace(l.lat, ',', '.') AS DOUBLE) AS lat,
                  CAST(replace(l.lng, ',', '.') AS DOUBLE) AS lon, c.timezone
           FROM (SELECT CAST(event_id AS INTEGER) AS id,
                        CASE event_id % 3 WHEN 0 THEN 'Hobart' WHEN 1 THEN 'Gold Coast'
                                          ELSE 'Perth' END AS city,
                        '-' || (10 + event_id % 34) || ','
                          || lpad(CAST(event_id * 7919 % 10000 AS VARCHAR), 4, '0') AS lat,
                        (113 + event_id % 40) || ','
                          || lpad(CAST(event_id * 104729 % 10000 AS VARCHAR), 4, '0') AS lng
                 FROM events) l
           JOIN city_dim c ON c.city = l.city""",
        "city_dim",
    ),
    "parse_timestamps": f"""
        WITH texts AS ({_TEXT_VARIANTS}),
        read AS (
          SELECT event_id, day,
            CASE WHEN regexp_matches(v, '^\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d\\.\\d{{1,9}}$')
                 THEN try_cast(left(v, 26) AS TIMESTAMP) END AS parsed_strict,
            try_cast(left(v, 26) AS TIMESTAMP) AS parsed
          FROM texts)
        SELECT event_id, parsed, parsed_strict,
               coalesce(parsed, CAST(day AS TIMESTAMP)) AS parsed_or_date
        FROM read
    """,
    "nearest_place_many": _with(
        f"""SELECT message_id, user_id, city FROM (
              SELECT *, row_number() OVER (
                PARTITION BY message_id, user_id, datetime ORDER BY km, city, lat, lon) AS place
              FROM (
                SELECT g.event_id AS message_id, g.user_id, g.ts AS datetime, c.city, g.lat,
                       g.lon, {_haversine('g.lat', 'g.lon', 'c.lat', 'c.lon')} AS km
                FROM geo g, (
                  SELECT 'place ' || c_custkey AS city,
                         -44 + c_custkey * 7919 % 34000 / 1000 AS lat,
                         113 + c_custkey * 104729 % 41000 / 1000 AS lon
                  FROM customer) c
                WHERE g.event_type = 'message'))
            WHERE place = 1""",
        "geo",
    ),
    "events_by_date_type": _with(
        "SELECT date, event_type, count(*) AS events FROM geo GROUP BY date, event_type", "geo"
    ),
    "events_window": _with(
        """SELECT event_id, date, event_type FROM geo
           WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
        "geo",
    ),
    "daily_presence": _with("SELECT * FROM presence", "presence"),
    "day_streaks": _with("SELECT * FROM streaks", "streaks"),
    "streaks_advanced": _with("SELECT * FROM streaks", "streaks"),
    "home_city": _with("SELECT * FROM home", "home"),
    "current_city": _with(
        "SELECT user_id, act_city, latest AS last_action_time FROM current_place", "current_place"
    ),
    "current_city_earliest": _with(
        "SELECT user_id, act_city, earliest AS last_action_time FROM current_place",
        "current_place",
    ),
    "travel_history": _with("SELECT * FROM travel", "travel"),
    "user_geo_mart": _with("SELECT * FROM users", "users"),
    "event_actor_city": _with("SELECT * FROM placed", "placed"),
    "calendar_buckets": _with(
        """SELECT date, CAST(date - CAST(dayofweek(date) AS INTEGER) AS DATE) AS week,
                  CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS events
           FROM geo GROUP BY date""",
        "geo",
    ),
    "registrations": _with("SELECT * FROM regs", "regs"),
    "registrations_by_user": _with("SELECT * FROM regs", "regs"),
    "activity_week": _with("SELECT * FROM week_counts", "week_counts"),
    "activity_month": _with("SELECT * FROM month_counts", "month_counts"),
    "zone_mart": _with(
        """SELECT w.month, w.city, w.week, w.week_message, w.week_reaction, w.week_subscription,
                  r.users AS week_user, m.month_message, m.month_reaction, m.month_subscription,
                  CAST(s.month_user AS BIGINT) AS month_user
           FROM week_counts w
           LEFT JOIN regs r ON r.city = w.city AND r.week = w.week AND r.month = w.month
           LEFT JOIN month_counts m ON m.city = w.city AND m.month = w.month
           LEFT JOIN (SELECT city, month, sum(users) AS month_user FROM regs GROUP BY city, month) s
             ON s.city = w.city AND s.month = w.month""",
        "week_counts",
        "regs",
        "month_counts",
    ),
    "shared_channel_pairs": _with("SELECT * FROM pairs", "pairs"),
    "shared_groups": _with(
        """SELECT channel, city, n AS members, n * (n - 1) // 2 AS links
           FROM (SELECT g.channel, u.home_city AS city, count(DISTINCT u.user_id) AS n
                 FROM users u JOIN geo g ON g.user_id = u.user_id AND g.event_type = 'subscription'
                 WHERE g.channel IS NOT NULL AND u.home_city IS NOT NULL
                 GROUP BY g.channel, u.home_city)
           WHERE n > 1""",
        "users",
        "geo",
    ),
    "contact_edges": _with("SELECT * FROM edges", "edges"),
    "exclude_contacts": _with("SELECT * FROM near_strangers", "near_strangers"),
    "within_km": _with(_near("wrote_pairs", "3.0"), "wrote_pairs", "spots"),
    "within_km_haversine": _with(
        _near("wrote_pairs", "3.0", _haversine), "wrote_pairs", "spots"
    ),
    "near_pairs": _with("SELECT * FROM near_interest", "near_interest"),
    "friends_mart": _with(
        """SELECT s.user_left, s.user_right, DATE '2024-02-01' AS processed_dttm, c.id AS zone_id,
                  timezone(c.timezone, timezone('UTC', TIMESTAMP '2024-02-01 12:30:00')) AS local_time
           FROM near_strangers s JOIN city_dim c ON c.city = s.city""",
        "near_strangers",
        "city_dim",
    ),
    "estimated_activity": _with(
        """SELECT city, date, CAST(sum(n) AS BIGINT) AS sampled,
                  round(sum(n * w), 6) AS estimate,
                  round(sqrt(sum(CAST(n AS DOUBLE) * n * w * (w - 1))), 6) AS standard_error
           FROM (SELECT city, date, user_id, count(*) AS n,
                        4294967296 / floor(0.4 * 4294967296) AS w
                 FROM matched
                 WHERE CAST('0x' || substr(md5('20:' || user_id), 1, 8) AS BIGINT)
                       < CAST(floor(0.4 * 4294967296) AS BIGINT)
                 GROUP BY city, date, user_id)
           GROUP BY city, date""",
        "matched",
    ),
    "city_rejects": """
        SELECT CASE event_id % 8 WHEN 0 THEN 'id' WHEN 1 THEN 'city' WHEN 2 THEN 'lat'
                                 WHEN 4 THEN 'lon' WHEN 5 THEN 'fields' ELSE 'fields' END AS reason,
               count(*) AS lines
        FROM events WHERE event_id % 8 IN (0, 1, 2, 4, 5, 6) GROUP BY 1""",
    "sample_users": _with(
        """SELECT user_id, home_city, act_city FROM users
           WHERE CAST('0x' || substr(md5('20:' || user_id), 1, 8) AS BIGINT)
                 < CAST(floor(0.4 * 4294967296) AS BIGINT)""",
        "users",
    ),
}
