import pytest

from hindcast.sources.payloads import gauge_readings, parse_weather, weather_hours

ROWS = [("17.11.2023 06:45", "3,75"), ("tomorrow", "4,0"), ("17.11.2023 07:45 Uhr", "NaN"), ("18.11.2023 00:15", "-0,25")]
ONE = '''<p>Gauge</p><table summary='x' class="wide tblsort"><thead><tr><th>Datum/Uhrzeit</th><th>Wassertemperatur</th></tr></thead><tbody>{}</tbody></table>'''.format(
    "".join(f"<tr><td>{at}</td><td>{value}</td></tr>" for at, value in ROWS))
TWO = """<table id=x class='big datentabelle'><thead><tr><th>Datum</th><th>Uhrzeit</th><th>Wassertemp.</th></tr></thead>
<tbody><tr><th>30.12.2022</th><td>23:10 Uhr</td><td> <b>1,5</b> </td></tr></tbody></table>"""
RENAMED = ONE.replace("Datum/Uhrzeit", "Zeitpunkt")


def read(spark, *pages):
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(pages)], "page string, html string")
    rows = gauge_readings(df, "wassertemp", keys=["page"]).orderBy("page", "wall").collect()
    return [(r.page, r.wall.isoformat(sep=" ", timespec="minutes"), r.value) for r in rows]


def test_layouts(spark):
    assert read(spark, ONE, TWO, RENAMED) == [
        ("0", "2023-11-17 06:45", 3.75), ("0", "2023-11-17 07:45", None), ("0", "2023-11-18 00:15", -0.25),
        ("1", "2022-12-30 23:10", 1.5),
        ("2", "2023-11-17 06:45", 3.75), ("2", "2023-11-17 07:45", None), ("2", "2023-11-18 00:15", -0.25),
    ]


@pytest.mark.parametrize("page", [
    "<html><body><p>No data</p></body></html>",
    ONE.replace("tblsort", "tblsorted"),
    ONE.replace("Wassertemperatur", "Abfluss"),
    TWO.replace("<th>Datum</th>", "<th>Tag</th>"),
])
def test_unrecognised_pages_give_no_rows(spark, page):
    assert read(spark, page) == []


def test_weather_payloads(spark):
    bodies = ['{"weather": []}', "{oops", None, "{}",
              '{"weather": [{"timestamp": "2026-05-01T10:00:00+00:00", "temperature": 1.5, "other": 3},'
              ' {"timestamp": "2026-05-01 11:00:00+02:00"}]}']
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    parsed = parse_weather(df)
    assert [r.status for r in parsed.orderBy("n").collect()] == ["empty", "failed", "failed", "empty", "ok"]
    rows = weather_hours(parsed, ["n"]).selectExpr("n", "cast(ts as string) ts", "temperature").orderBy("ts").collect()
    assert [(r.n, r.ts, r.temperature) for r in rows] == [(4, "2026-05-01 09:00:00", None), (4, "2026-05-01 10:00:00", 1.5)]
