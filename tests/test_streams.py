from __future__ import annotations

import pytest

from contrail import registry, testbed
from contrail.plans import marts
from contrail.streaming import feeds

SF = "/root/testdata/sf0.001"
EXACT = {
    "minute_metrics": ["total_flights", "on_ground", "airborne", "max_altitude_ft", "max_speed_knots", "emergency_count"],
    "hourly_trend": ["emergency_count"],
}


@pytest.mark.parametrize(
    ("name", "time", "exact", "near"),
    [("minute_metrics", "metric_time", "unique_aircraft", "unique_aircraft_approx"), ("hourly_trend", "hour_bucket", "flight_count", "flight_count_approx")],
)
def test_stream_keeps_open_windows(spark, tmp_path, name, time, exact, near):
    rows = feeds.clean_stream(testbed.raw_l(registry._event_stream(spark, SF)))
    stream = getattr(feeds, name)(rows)
    out = str(tmp_path / "out")
    feeds.write_newest(stream, out, str(tmp_path / "progress")).awaitTermination()
    got = {(r[time], r.region): r for r in feeds.read_newest(spark, out, stream.schema, [time, "region"]).collect()}
    want = {(r[time], r.region): r for r in getattr(marts, name)(registry._clean_l(spark, SF)).collect()}
    assert got.keys() == want.keys() and got
    for key, r in want.items():
        assert [got[key][c] for c in EXACT[name]] == [r[c] for c in EXACT[name]]
        assert got[key].avg_altitude_ft == pytest.approx(r.avg_altitude_ft)
        assert abs(got[key][near] - r[exact]) <= max(1, 0.2 * r[exact])
