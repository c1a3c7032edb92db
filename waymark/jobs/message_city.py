"""Messages of the log with their nearest city."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.jobs import open_session, parser
from waymark.operators.nearest import message_city
from waymark.schemas import CITY_DIM, MESSAGE_CITY
from waymark.sources.bucketed import BUCKETS, write_bucketed
from waymark.sources.events import events_window, read_events, window_days
from waymark.sources.tables import read_table, replace_window, write_table


def run(
    spark: SparkSession,
    cities: str,
    events: str,
    out: str,
    lenient: bool = True,
    end: str | None = None,
    depth: int | None = None,
    by_user: str | None = None,
    buckets: int = BUCKETS,
) -> None:
    """The whole log, or the ``depth`` days that end at ``end``: of an earlier table those days
    are then replaced, whether or not they have messages, and all others stay. ``by_user``
    names a second table of all messages, in ``buckets`` by user for the jobs that join it."""
    log = read_events(spark, events)
    if (end is None) != (depth is None):
        raise ValueError("end and depth of a window go together")
    windowed = end is not None
    if windowed:
        log = events_window(log, end, depth)
    places = read_table(spark, cities, CITY_DIM, "city_dim")
    matched = message_city(log, places, lenient)
    if windowed:
        replace_window(matched, out, *window_days(end, depth))
    else:
        write_table(matched, out, ["date"])
    if by_user:
        whole = read_table(spark, out, MESSAGE_CITY, "message_city")
        write_bucketed(whole, by_user, "user_id", buckets)


def main(argv: list[str] | None = None) -> None:
    options = parser(__doc__, "cities", "events", "out")
    options.add_argument("--strict-timestamps", action="store_true")
    options.add_argument("--end", help="last day of a date window, with --depth")
    options.add_argument("--depth", type=int, help="days in the window")
    options.add_argument("--by-user", help="where to put the messages by user as well")
    options.add_argument("--buckets", type=int, default=BUCKETS)
    args = options.parse_args(argv)
    if (args.end is None) != (args.depth is None):
        options.error("--end and --depth go together")
    run(
        open_session("message-city"),
        args.cities, args.events, args.out, not args.strict_timestamps, args.end, args.depth,
        args.by_user, args.buckets,
    )


if __name__ == "__main__":
    main()
