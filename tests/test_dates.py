from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd

from ledgerflow.functions import dates


def run(spark, items, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in rows.select("i", expr.alias("o")).orderBy("i").collect()]


#: Text and what it means; None where the text is no date.
READ_AS = {
    "2024-1-2 03:04:05": "2024-01-02 03:04:05", "2024/1/2 3:04:05": "2024-01-02 03:04:05",
    "2024-01-02": "2024-01-02", "2024/01/02": "2024-01-02", "2024/1/2": None, "20240102": "2024-01-02",
    "20240102030405": "2024-01-02 03:04:05", "2024-01-02T01:00:00": None, "2024-01-02 01:02:03.5": None,
    "2024-02-30": None, "99999999": None, "abc": None, "": None, "2024-01-02 24:00:00": None,
    "2024-01-02 23:59:60": "2024-01-03 00:00:00", "9999-12-31": "9999-12-31", "0001-01-01": "0001-01-01",
    " 2024-01-02 01:02:03 ": "2024-01-02 01:02:03", "20240102235961": "2024-01-03 00:00:01",
    "2262-04-11": "2262-04-11", "2262-04-12": "2262-04-12", "2024-01/02": None, "2023-02-29": None,
    "2024-02-29": "2024-02-29", "1999-12-31\n": "1999-12-31",
}


def test_text_layouts(spark):
    found = run(spark, list(READ_AS), "string", dates.timestamp_from_text("v"))
    wanted = [None if v is None else dt.datetime.fromisoformat(v) for v in READ_AS.values()]
    assert dict(zip(READ_AS, found)) == dict(zip(READ_AS, wanted))


def test_random_texts_equal_duckdb(spark):
    draw = random.Random(7)
    items = []
    for _ in range(800):
        year, parts = draw.randint(1, 9999), [draw.randint(0, n) for n in (13, 32, 24, 60, 59)]
        mark = draw.choice("-/")
        items.append(f"{year:04}{mark}{parts[0]:02}{mark}{parts[1]:02} {parts[2]:02}:{parts[3]:02}:{parts[4]:02}")
    layouts = "['%Y-%m-%d %H:%M:%S', '%Y/%m/%d %H:%M:%S']"
    frame = pd.DataFrame({"i": range(len(items)), "v": items})
    duck = duckdb.connect()
    duck.register("frame", frame)
    wanted = duck.sql(f"SELECT try_strptime(v, {layouts}) FROM frame ORDER BY i").fetchall()
    assert run(spark, items, "string", dates.timestamp_from_text("v")) == [w[0] for w in wanted]


def test_integers_by_length(spark):
    items = [20240102, 240102, 690102, 202401020304, 20240102030405, 99999999, 1700000000000000000, None]
    assert run(spark, items, "bigint", dates.timestamp_from_integer("v")) == [
        dt.datetime(2024, 1, 2),
        dt.datetime(2024, 1, 2),
        dt.datetime(1969, 1, 2),
        dt.datetime(2024, 1, 2, 3, 4),
        dt.datetime(2024, 1, 2, 3, 4, 5),
        None,
        dt.datetime(2023, 11, 14, 22, 13, 20),
        None,
    ]


def test_spreadsheet_serials(spark):
    items = [45000.5, 59.0, 60.0, None, 200000.0, 2958465.0]
    found = run(spark, items, "double", dates.timestamp_from_serial("v"))
    far = [dt.datetime(2447, 7, 30), dt.datetime(9999, 12, 31)]
    assert found == [dt.datetime(2023, 3, 15, 12), None, dt.datetime(1900, 2, 28), None, *far]


def test_log_and_page_dates(spark):
    log = ["03/11/25 01.02.03", "31/02/25 01.02.03", "3/1/70 1.2.3", "x", None, "03/11/25 01.02.03\n"]
    assert run(spark, log, "string", dates.timestamp_from_log("v")) == [
        dt.datetime(2025, 11, 3, 1, 2, 3), None, dt.datetime(1970, 1, 3, 1, 2, 3), None, None, None,
    ]
    page = ["11/03/25", "24/11/03", None]
    assert run(spark, page, "string", dates.date_from_page_header("v")) == [
        dt.date(2025, 11, 3), None, None,
    ]


def test_session_time_zone_does_not_matter(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = run(spark, ["2024-03-10 02:30:00"], "string", dates.timestamp_from_text("v"))
        nanos = run(spark, [1700000000000000000], "bigint", dates.timestamp_from_integer("v"))
        assert found == [dt.datetime(2024, 3, 10, 2, 30)]
        assert nanos == [dt.datetime(2023, 11, 14, 22, 13, 20)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
