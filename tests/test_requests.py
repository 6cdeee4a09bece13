"""Request bodies as the API guide writes them."""

from raretide.sources.requests import REQUIRED_WITHOUT_TIME, parse_requests


def _parse(spark, body, **kw):
    return parse_requests(spark.createDataFrame([(1, body)], "row_id long, request string"), **kw).collect()


def test_documented_single_request(spark):
    row, = _parse(spark, '{"timestamp": "2024-01-01T12:00:00", "temperature": 75.5, "vibration": 0.8, "pressure": 105.2}')
    assert row["valid"] and str(row["ts"]) == "2024-01-01 12:00:00" and row["pressure"] == 105.2


def test_array_body(spark):
    rows = _parse(spark, """[{"timestamp": "2024-01-01T12:00:00", "temperature": 75.5, "vibration": 0.8, "pressure": 105.2},
                            {"timestamp": "2024-01-01T13:00:00", "temperature": 76.0, "vibration": 0.9}]""")
    assert [r["valid"] for r in rows] == [True, False] and rows[1]["error"] == "Missing required field: pressure"


def test_three_fields_are_stamped_on_arrival(spark):
    row, = _parse(spark, '{"temperature": 50.0, "vibration": 0.5, "pressure": 100}', required=REQUIRED_WITHOUT_TIME)
    assert row["valid"] and row["ts"] is not None


def test_bad_bodies_are_rejected(spark):
    for body, error in (("{}", "Missing required field: timestamp"), ("no json", "Missing required field: timestamp"), ("[oops", "Missing required field: timestamp"),
                        ('{"timestamp": "x", "temperature": 1, "vibration": 1, "pressure": 1}', "Invalid input data: timestamp"),
                        ('{"timestamp": "2024-01-01", "temperature": "hot", "vibration": 1, "pressure": 1}', "Invalid input data: temperature")):
        row, = _parse(spark, body)
        assert not row["valid"] and row["error"] == error
