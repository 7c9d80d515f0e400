"""Results must not depend on the session time zone (driver timestamps are
TIMESTAMP_NTZ; a DST zone must not move wall-clock values)."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

Q = E.queries()
TZ_SENSITIVE = ["timestamp_parse", "date_parts", "date_arithmetic", "min_max_duration",
                "count_distinct", "running_sum", "asof_left_join", "weekday_gate",
                "first_event_date", "cutoff_join", "next_day_retention"]


@pytest.mark.parametrize("name", TZ_SENSITIVE)
def test_same_result_in_a_dst_zone(spark, name):
    def rows():
        return sorted(map(repr, Q[name](spark, SF_SMALL).collect()))
    utc = rows()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        other = rows()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
