"""Friends mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from waymark.functions.distance import METRICS
from waymark.jobs import instant, open_session, parser
from waymark.operators.sampling import sample_users
from waymark.plans.friends import friends_mart
from waymark.schemas import CITY_DIM, MESSAGE_CITY, USER_GEO_MART
from waymark.sources.bucketed import open_table
from waymark.sources.events import read_events
from waymark.sources.tables import read_table, write_table


def run(
    spark: SparkSession,
    user_geo: str,
    events: str,
    message_city: str,
    cities: str,
    out: str,
    as_of: dt.datetime | None = None,
    km: float = 1.0,
    metric: str = "planar",
    sample: float | None = None,
) -> None:
    users = open_table(spark, user_geo, USER_GEO_MART, "user_geo_mart")
    mart = friends_mart(
        users if sample is None else sample_users(users, sample),
        read_events(spark, events),
        open_table(spark, message_city, MESSAGE_CITY, "message_city"),
        read_table(spark, cities, CITY_DIM, "city_dim"),
        as_of,
        km,
        metric,
    )
    write_table(mart, out)


def main(argv: list[str] | None = None) -> None:
    options = parser(__doc__, "user_geo", "events", "message_city", "cities", "out")
    options.add_argument("--as-of", type=instant, help="time of the run, UTC; now if not given")
    options.add_argument("--km", type=float, default=1.0)
    options.add_argument("--metric", choices=sorted(METRICS), default="planar")
    options.add_argument("--sample", type=float, help="fraction of users; all if not given")
    args = options.parse_args(argv)
    run(
        open_session("friends"),
        args.user_geo, args.events, args.message_city, args.cities, args.out,
        args.as_of, args.km, args.metric, args.sample,
    )


if __name__ == "__main__":
    main()
