"""City list (CSV) to the city dimension."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.jobs import open_session, parser, zone_overrides
from waymark.sources.cities import DEFAULT_ZONE, load_cities
from waymark.sources.tables import write_table


def run(
    spark: SparkSession, csv: str, out: str, default=DEFAULT_ZONE, overrides=None, rejects=None
) -> None:
    write_table(load_cities(spark, csv, default, overrides, rejects), out)


def main(argv: list[str] | None = None) -> None:
    options = parser(__doc__, "csv", "out")
    options.add_argument("--default-zone", default=DEFAULT_ZONE)
    options.add_argument("--zone", action="append", default=[], metavar="CITY=ZONE")
    options.add_argument("--rejects", help="where lines go that cannot be used")
    args = options.parse_args(argv)
    overrides = zone_overrides(args.zone)
    run(open_session("cities"), args.csv, args.out, args.default_zone, overrides, args.rejects)


if __name__ == "__main__":
    main()
