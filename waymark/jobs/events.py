"""Raw event log to the log laid out by date and event type."""

from __future__ import annotations

from pyspark.sql import SparkSession

from waymark.jobs import open_session, parser
from waymark.sources.events import ingest_events


def run(spark: SparkSession, raw: str, out: str, rebalance: bool = True) -> None:
    ingest_events(spark.read.parquet(raw), out, rebalance)


def main(argv: list[str] | None = None) -> None:
    options = parser(__doc__, "raw", "out")
    options.add_argument(
        "--no-shuffle", action="store_true", help="the source is already stored by date"
    )
    args = options.parse_args(argv)
    run(open_session("events"), args.raw, args.out, not args.no_shuffle)


if __name__ == "__main__":
    main()
