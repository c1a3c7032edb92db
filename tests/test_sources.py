import datetime as dt

import pytest
from conftest import planned, rows
from pyspark.sql import functions as F

from waymark import schemas
from waymark.operators.messages import normalize_messages
from waymark.sources.cities import AREA_ZONES, CITIES, load_cities, with_timezone
from waymark.sources.events import events_window, ingest_events, read_events
from waymark.sources.tables import read_table, replace_window, write_table


def test_city_csv_with_bare_carriage_returns(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_bytes(
        b"id;city;lat;lng\r1;Sydney;-33,865;151,2094\r6;Gold Coast;-28,0167;153,4\r"
        b"15;Cairns;-16,9303;145,7703\r4;Perth;-31,9522;115,8589\r"
    )
    found = load_cities(spark, str(path))
    assert rows(found) == [
        (1, "Sydney", -33.865, 151.2094, "Australia/Sydney"),
        (4, "Perth", -31.9522, 115.8589, "Australia/Perth"),
        (6, "Gold Coast", -28.0167, 153.4, "Australia/Sydney"),
        (15, "Cairns", -16.9303, 145.7703, "Australia/Sydney"),
    ]


def test_city_csv_with_newlines_reads_the_same(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("id;city;lat;lng\n1;Sydney;-33,865;151,2094\n")
    assert rows(load_cities(spark, str(path))) == [
        (1, "Sydney", -33.865, 151.2094, "Australia/Sydney")
    ]


def test_zone_overrides_correct_the_default(spark):
    named = spark.createDataFrame([("Bunbury",), ("Perth",), ("Cairns",), (None,)], "city string")
    found = with_timezone(named, overrides={"Bunbury": "Australia/Perth"})
    assert dict(map(tuple, found.collect())) == {
        "Bunbury": "Australia/Perth",
        "Perth": "Australia/Perth",
        "Cairns": "Australia/Sydney",
        None: "Australia/Sydney",
    }
    other = with_timezone(named, default="Australia/Brisbane")
    assert dict(map(tuple, other.collect()))["Cairns"] == "Australia/Brisbane"


def test_every_zone_is_known_to_the_engine(spark):
    for name in AREA_ZONES:
        spark.sql(f"SELECT from_utc_timestamp(timestamp'2024-01-01', 'Australia/{name}')").collect()
    assert len({name for _, name, _, _ in CITIES}) == 24


def test_ingest_lays_out_by_date_and_type_and_prunes(spark, log, tmp_path):
    day = lambda n: dt.date(2024, 1, n)
    events = log(*[
        {"type": kind, "user": 1, "date": day(n), "lat": 1.0, "lon": 2.0}
        for n in range(1, 11)
        for kind in ("message", "reaction", "subscription")
    ])
    path = str(tmp_path / "events")
    ingest_events(events, path)
    back = read_events(spark, path)
    assert rows(back, "event.message_id", "event_type", "date") == rows(
        events, "event.message_id", "event_type", "date"
    )

    messages = planned(normalize_messages(back))
    assert "PartitionFilters: [isnotnull(event_type" in messages
    read = messages[messages.index("ReadSchema"):]
    assert "message_from" in read and "reaction_from" not in read and "channel" not in read

    window = events_window(back, "2024-01-07", 3)
    assert sorted({r.date for r in window.collect()}) == [day(5), day(6), day(7)]
    scan = planned(window)
    filters = scan[scan.index("PartitionFilters"):].split("]")[0]
    assert "date" in filters and ">=" in filters and "<=" in filters


def test_wider_logs_are_read_by_name_and_still_pruned(spark, log, tmp_path):
    from pyspark.sql import functions as F

    events = log({"user": 1, "to": 2}, {"type": "reaction", "user": 3})
    names = [f.name for f in events.schema["event"].dataType]
    wider = F.struct(F.lit("x").alias("extra"), *[F.col(f"event.{n}") for n in reversed(names)])
    path = str(tmp_path / "events")
    ingest_events(events.withColumn("event", wider).withColumn("more", F.lit(1)), path)
    back = read_events(spark, path)
    assert rows(normalize_messages(back)) == rows(normalize_messages(events))
    plan = planned(normalize_messages(back))
    read = plan[plan.index("ReadSchema"):]
    assert "message_from" in read and "extra" not in read and "reaction_from" not in read
    assert "event_type" in plan[plan.index("PartitionFilters"):].split("]")[0]

    narrow = str(tmp_path / "narrow")
    ingest_events(events.withColumn("event", F.col("event").dropFields("user")), narrow)
    with pytest.raises(ValueError, match="event.user: missing"):
        read_events(spark, narrow)


def test_contact_filter_reaches_the_scan(spark, log, tmp_path):
    from waymark.operators.pairs import direct_contacts

    path = str(tmp_path / "events")
    ingest_events(log({"user": 1, "to": 2}, {"type": "reaction", "user": 1}), path)
    scan = planned(direct_contacts(read_events(spark, path)))
    assert "GreaterThan(event.message_to,0)" in scan
    assert "event_type" in scan[scan.index("PartitionFilters"):].split("]")[0]


def test_ingest_without_rebalance_gives_the_same_rows(spark, log, tmp_path):
    events = log({"user": 1}, {"type": "reaction", "user": 2, "date": dt.date(2024, 1, 2)})
    path = str(tmp_path / "events")
    ingest_events(events, path, rebalance=False)
    assert read_events(spark, path).count() == 2


def test_events_window_rejects_an_empty_window(log):
    with pytest.raises(ValueError):
        events_window(log({"user": 1}), "2024-01-07", 0)


def test_contract_violations_are_named(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).selectExpr("id", "'x' AS city", "'1' AS lat", "2.0D AS lon").write.parquet(path)
    with pytest.raises(ValueError) as fault:
        read_table(spark, path, schemas.CITY_DIM, "city_dim")
    for part in ("city_dim", "id: bigint", "lat: string", "timezone: missing"):
        assert part in str(fault.value)


def test_numeric_city_directories_stay_text(spark, tmp_path):
    path = str(tmp_path / "users")
    users = spark.createDataFrame(
        [(1, "1770", 1, ["1770"], dt.datetime(2024, 1, 1), "1770")], schemas.USER_GEO_MART
    )
    write_table(users, path, ["act_city"])
    assert read_table(spark, path, schemas.USER_GEO_MART, "users").first().act_city == "1770"


def test_directories_are_rebalanced_before_writing(spark, tmp_path):
    """One file per small directory, though every task has rows of each."""
    from pyspark.sql import functions as F

    frame = spark.range(0, 400, 1, 8).withColumn("date", F.col("id") % 4)
    files = lambda path: len(list(path.glob("date=*/*.parquet")))
    write_table(frame, str(tmp_path / "one"), ["date"])
    write_table(frame, str(tmp_path / "many"), ["date"], rebalance=False)
    assert files(tmp_path / "one") == 4 and files(tmp_path / "many") == 32


def test_only_partitions_keeps_the_others(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    days = lambda *ids: spark.createDataFrame([(n, n % 3) for n in ids], "id long, date long")
    write_table(days(0, 1, 2, 3), path, ["date"])
    write_table(days(31), path, ["date"], only_partitions=True)
    assert rows(spark.read.parquet(path), "id") == [(0,), (2,), (3,), (31,)]


def test_city_list_goes_by_its_header(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("id;city;note;lng;lat\n12;Hobart;x;147,325;-42,8806\n")
    assert rows(load_cities(spark, str(path))) == [
        (12, "Hobart", -42.8806, 147.325, "Australia/Hobart")
    ]
    path.write_text("id;city;lat\n1;Hobart;2\n")
    with pytest.raises(ValueError, match="lng"):
        load_cities(spark, str(path))


def test_rejected_city_lines(spark, tmp_path):
    text = "lat;id;city;lng;more\n" + "\n".join([
        "-31,9;1;Perth;115,8;x", "abc;2;Perth;115,8;x", "-31,9;;Perth;115,8;x",
        "-31,9;4; ;115,8;x", "-31,9;5;Perth;Infinity;x", "-31,9;6;Perth", "1;7;P;2;x;y",
        "-33,0;8;Sydney;151;",
    ]) + "\n"
    (tmp_path / "cities.csv").write_text(text)
    path, out = str(tmp_path / "cities.csv"), str(tmp_path / "rejects")
    found = load_cities(spark, path, rejects=out)
    assert rows(found, "id", "lat", "lon") == [(1, -31.9, 115.8), (8, -33.0, 151.0)]
    rejects = rows(spark.read.parquet(out))
    assert sorted(r for _, r in rejects) == ["city", "fields", "fields", "id", "lat", "lon"]
    assert ("-31,9;6;Perth", "fields") in rejects and ("2;Perth;abc;115,8", "lat") in rejects
    # Without a place for them they are left out all the same.
    assert load_cities(spark, path).count() == 2


def test_a_window_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = lambda *given: spark.createDataFrame(
        [(n, dt.date(2024, 1, day)) for n, day in given], "n long, date date"
    )
    write_table(frame((1, 1), (2, 2), (3, 3), (4, 4)), path, ["date"])
    read = lambda: rows(spark.read.parquet(path).select("n", F.dayofmonth("date")))
    window = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    replace_window(frame((5, 3), (6, 3)), path, *window)
    assert read() == [(1, 1), (4, 4), (5, 3), (6, 3)]
    # From the table itself, and with nothing left.
    held = spark.read.parquet(path).where("n <> 5").select(F.col("n") + 10, "date").toDF("n", "date")
    replace_window(held.where("date = DATE '2024-01-03'"), path, *window)
    assert read() == [(1, 1), (4, 4), (16, 3)]
    replace_window(frame(), path, *window)
    assert read() == [(1, 1), (4, 4)]
    with pytest.raises(ValueError):
        replace_window(frame((7, 1)), path, *window)
    assert read() == [(1, 1), (4, 4)]
    new = str(tmp_path / "new")
    replace_window(frame((5, 3)), new, *window)
    assert rows(spark.read.parquet(new).select("n")) == [(5,)]
