"""Zone mart."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.jobs import open_session, parser
from waymark.operators.sampling import sample_users
from waymark.plans.zone import zone_mart
from waymark.schemas import MESSAGE_CITY, USER_GEO_MART
from waymark.sources.bucketed import open_table
from waymark.sources.events import read_events
from waymark.sources.tables import write_table


def run(
    spark: SparkSession,
    user_geo: str,
    events: str,
    message_city: str,
    out: str,
    fill_zero: bool = False,
    sample: float | None = None,
) -> None:
    users = open_table(spark, user_geo, USER_GEO_MART, "user_geo_mart")
    mart = zone_mart(
        read_events(spark, events),
        open_table(spark, message_city, MESSAGE_CITY, "message_city"),
        users if sample is None else sample_users(users, sample),
        fill_zero,
    )
    write_table(mart, out)


def main(argv: list[str] | None = None) -> None:
    options = parser(__doc__, "user_geo", "events", "message_city", "out")
    options.add_argument("--fill-zero", action="store_true")
    options.add_argument("--sample", type=float, help="fraction of users; all if not given")
    args = options.parse_args(argv)
    run(
        open_session("zones"),
        args.user_geo, args.events, args.message_city, args.out, args.fill_zero, args.sample,
    )


if __name__ == "__main__":
    main()
