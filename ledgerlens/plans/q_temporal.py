"""Catalogue part 6: as-of joins, sessions and range frames (J9, W18) over ``events``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.operators import temporal as X
from ledgerlens.plans.oracle_sql import sql
from ledgerlens.plans.registry import finish, query
from ledgerlens.sources import tables as T

HOUR = 3_600_000_000        # microseconds
WEEK = 7 * 24 * HOUR


def _micros(ts: str) -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone is."""
    minutes = (F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.expr(f"extract(SECOND FROM {ts})") * 1_000_000).cast("long")


def _events(spark, d):
    return T.load(spark, d, "events").select("event_id", "user_id", "event_type", _micros("ts").alias("us"), "value")


EVENTS = """ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us, value FROM events)"""


@query("asof_last_click")
def asof_last_click(spark, d):
    """Each purchase with its user's latest click of the last week."""
    e = _events(spark, d)
    clicks = e.filter("event_type = 'click'").withColumnsRenamed({"event_id": "click_id", "value": "click_value"})
    out = X.asof_join(e.filter("event_type = 'purchase'"), clicks, "user_id", "us", ["click_id", "click_value"],
                      width=4 * WEEK, tiebreak="click_id", within=WEEK)
    return finish(out.select("event_id", "user_id", "us", "click_id", "click_value"))


sql("asof_last_click", f"""
SELECT p.event_id, any_value(p.user_id) AS user_id, any_value(p.us) AS us,
       arg_max(c.event_id, (c.us, c.event_id)) AS click_id, arg_max(c.value, (c.us, c.event_id)) AS click_value
FROM ev p LEFT JOIN ev c ON c.user_id = p.user_id AND c.event_type = 'click' AND c.us <= p.us AND p.us - c.us <= {WEEK}
WHERE p.event_type = 'purchase' GROUP BY p.event_id
""", ctes=EVENTS)


@query("user_sessions")
def user_sessions(spark, d):
    """Sessions of a user end after 12 hours without an event."""
    return finish(X.session_summary(_events(spark, d), "user_id", "us", 12 * HOUR, 4 * WEEK, "event_id",
                                    {"total_value": F.sum("value"), "n_purchases": F.sum((F.col("event_type") == "purchase").cast("long"))}))


sql("user_sessions", f"""
SELECT user_id, session, min(us) AS session_start, max(us) AS session_end, count(*) AS n_rows, sum(value) AS total_value,
       CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS n_purchases
FROM (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id) AS BIGINT) AS session FROM (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= {12 * HOUR} THEN 0 ELSE 1 END AS new FROM ev))
GROUP BY user_id, session
""", ctes=EVENTS, rnd=["total_value"])


@query("rolling_week")
def rolling_week(spark, d):
    """Number, sum and largest value of a user's events of the week up to each event."""
    return finish(X.range_frame(_events(spark, d), "user_id", "us", WEEK,
                                {"n_week": F.count("value"), "sum_week": F.sum("value"), "max_week": F.max("value")})
                  .select("event_id", "user_id", "n_week", "sum_week", "max_week"))


sql("rolling_week", f"""
SELECT event_id, user_id, count(value) OVER w AS n_week, sum(value) OVER w AS sum_week, max(value) OVER w AS max_week
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN {WEEK} PRECEDING AND CURRENT ROW)
""", ctes=EVENTS, rnd=["sum_week", "max_week"])
