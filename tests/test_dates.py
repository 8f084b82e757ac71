import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.functions import dates as D

T = dt.datetime
CASES = {
    "2026-06-21T10:00:00.000Z": T(2026, 6, 21, 10), "2026-06-21T10:00:00.123456789": T(2026, 6, 21, 10, 0, 0, 123456), "2026-06-21T10:00:00+02:00": T(2026, 6, 21, 8),
    "2026-06-21 10:00:00-0530": T(2026, 6, 21, 15, 30), "2026-06-21T23:30+00": T(2026, 6, 21, 23, 30), "2026-06-21T10:00Z": T(2026, 6, 21, 10),
    "2026/06/21 10:05": T(2026, 6, 21, 10, 5), "2026.06.21": T(2026, 6, 21), "21.06.2026": T(2026, 6, 21), "06.07.2026": T(2026, 6, 7), "June 21, 2026": T(2026, 6, 21),
    "Jun. 21 2026": T(2026, 6, 21), "Sept 3, 2026 4:05 PM": T(2026, 9, 3, 16, 5), "21 June 2026": T(2026, 6, 21), "21-Jun-2026 10:00:01": T(2026, 6, 21, 10, 0, 1),
    "1/2/2026 12:30 AM": T(2026, 1, 2, 0, 30), "31/12/2026 23:59:59": T(2026, 12, 31, 23, 59, 59), "20260621T101500Z": T(2026, 6, 21, 10, 15),
    "Sunday, June 21, 2026": T(2026, 6, 21), "Sun, 21 Jun 2026 10:00:00 GMT": T(2026, 6, 21, 10), "2026-06-21 10:00:00,5": T(2026, 6, 21, 10, 0, 0, 500000),
    "2026-06-21 10:00:00 UTC": T(2026, 6, 21, 10), "12/31/2026 12:00 pm": T(2026, 12, 31, 12), "2026-6-1T1:02:03.5Z": T(2026, 6, 1, 1, 2, 3, 500000),
    # no dates
    "June 31, 2026": None, "2026-02-30T10:00:00Z": None, "Juny 21, 2026": None, "2026-06-21T25:00:00Z": None, "2026-06-21T10:61Z": None, "13:00": None,
    "1/2/2026 13:30 PM": None, "2026-06-21T10:00:00+99:00": None, "word 12, 2026": None, "Order 66": None, "1.2.3": None, "": None, "20260621": None,
}


def test_written_forms(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", D.parse_datetime(F.col("s")).alias("t")).collect()}
    assert {k: v for k, v in got.items() if v != CASES[k]} == {}


@pytest.mark.parametrize("form", ["%Y-%m-%dT%H:%M:%S.%fZ", "%B %d, %Y %I:%M:%S %p", "%d.%m.%Y %H:%M:%S", "%d %b %Y %H:%M:%S+0000"])
def test_any_time_of_a_form(spark, form):
    times = [T(1970 + k, 1 + k % 12, 13 + k % 15, (7 * k) % 24, (13 * k) % 60, (29 * k) % 60) for k in range(80)]
    df = spark.createDataFrame([(t.strftime(form), t) for t in times], "s string, t timestamp")
    assert df.where(~D.parse_datetime(F.col("s")).eqNullSafe(F.col("t"))).count() == 0
