"""One spark-submit entry point per stage; each hands its table on through Parquet.

    spark-submit --py-files waymark.zip waymark/jobs/<stage>.py …

The order is cities and events, then message_city, then user_geo, then zones and friends.
Master, resources and shuffle settings come from the submit command.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from waymark.session import join_by_user, prepare_session


def open_session(name: str) -> SparkSession:
    session = SparkSession.builder.appName(f"waymark-{name}").getOrCreate()
    return join_by_user(prepare_session(session))


def parser(description: str, *paths: str) -> argparse.ArgumentParser:
    """Argument parser with the given positional paths, in order."""
    found = argparse.ArgumentParser(description=description)
    for path in paths:
        found.add_argument(path)
    return found


def zone_overrides(pairs: Sequence[str]) -> dict[str, str]:
    """``City=Area/Zone`` arguments as a mapping."""
    for pair in pairs:
        if "=" not in pair:
            raise ValueError(f"expected City=Zone, got {pair!r}")
    return dict(pair.split("=", 1) for pair in pairs)


def instant(text: str) -> dt.datetime:
    """An ISO date and time; taken as UTC unless it names an offset."""
    found = dt.datetime.fromisoformat(text)
    if found.tzinfo:
        found = found.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return found
