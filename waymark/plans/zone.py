"""Zone mart: activity and registrations per city, week and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.events import EVENT_TYPES
from waymark.operators.activity import CITY_WEEK, city_activity, registrations, roll_up
from waymark.schemas import ZONE_MART


def zone_mart(
    events: DataFrame, message_city: DataFrame, user_geo: DataFrame, fill_zero: bool = False
) -> DataFrame:
    """One row per city, week and month with counts of the week's part of that month and of
    the whole month; absent counts are NULL, or 0 with ``fill_zero``.

    The log is read once: months are summed from the weekly rows, of which there are only
    as many as cities and weeks. A week across two months stays two rows throughout.
    """
    weekly = city_activity(events, user_geo)
    in_month = Window.partitionBy("city", "month")
    monthly = {f"month_{t}": F.sum(f"week_{t}").over(in_month) for t in EVENT_TYPES}
    joined = registrations(message_city, user_geo).withColumnRenamed("users", "week_user")
    month_user = roll_up(joined, ["city", "month"], {"week_user": "month_user"})
    mart = (
        weekly.withColumns(monthly)
        .join(joined, list(CITY_WEEK), "left")
        .join(month_user, ["city", "month"], "left")
        .select(*ZONE_MART.names)
    )
    return mart.fillna(0) if fill_zero else mart
