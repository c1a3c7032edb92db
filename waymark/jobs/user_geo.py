"""User mart."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.jobs import open_session, parser
from waymark.operators.residence import HOME_DAYS
from waymark.plans.user_geo import user_geo_mart
from waymark.schemas import CITY_DIM, MESSAGE_CITY
from waymark.sources.bucketed import open_table, write_bucketed
from waymark.sources.tables import read_table, write_table


def run(
    spark: SparkSession,
    message_city: str,
    cities: str,
    out: str,
    min_days: int = HOME_DAYS,
    activity: str = "latest",
    buckets: int | None = None,
) -> None:
    """The mart by current city, or in ``buckets`` by user for the jobs that join it."""
    mart = user_geo_mart(
        open_table(spark, message_city, MESSAGE_CITY, "message_city"),
        read_table(spark, cities, CITY_DIM, "city_dim"),
        min_days,
        activity,
    )
    if buckets:
        write_bucketed(mart, out, "user_id", buckets)
    else:
        write_table(mart, out, ["act_city"])


def main(argv: list[str] | None = None) -> None:
    options = parser(__doc__, "message_city", "cities", "out")
    options.add_argument("--home-days", type=int, default=HOME_DAYS)
    options.add_argument("--activity", choices=("latest", "earliest"), default="latest")
    options.add_argument("--buckets", type=int, help="store by user in so many buckets")
    args = options.parse_args(argv)
    run(
        open_session("user-geo"),
        args.message_city, args.cities, args.out, args.home_days, args.activity,
        args.buckets,
    )


if __name__ == "__main__":
    main()
