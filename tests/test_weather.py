import pytest

from aerolag.operators import breakdown, weather
from aerolag.schema import SPECIAL_WEATHER

PACKED = "WND string, CIG string, VIS string, TMP string, DEW string, SLP string"


def _one(spark, **fields):
    row = tuple(fields.get(c) for c in ("WND", "CIG", "VIS", "TMP", "DEW", "SLP"))
    return spark.createDataFrame([row], PACKED)


def test_temperature(spark):
    assert weather.parse_packed(_one(spark, TMP="+0104,1")).first()["temperature"] == pytest.approx(10.4)
    assert weather.parse_packed(_one(spark, TMP="-0011,1")).first()["temperature"] == pytest.approx(-1.1)


def test_missing_codes_by_mode(spark):
    df = _one(spark, TMP="+9999,9", WND="999,9,V,9999,9", VIS="999999,9,N,9")
    isd = weather.parse_packed(df).first()
    assert isd["temperature"] is None and isd["wind_speed"] is None and isd["visibility"] is None
    loose = weather.parse_packed(df, sentinels="reference").first()
    assert loose["temperature"] == pytest.approx(999.9)
    assert loose["wind_speed"] == pytest.approx(999.9)
    assert loose["gust_speed"] == 9.0
    assert loose["visibility"] == pytest.approx(999.999)


def test_short_and_unreadable(spark):
    row = weather.parse_packed(_one(spark, WND="12,1", CIG="", VIS="x,1")).first()
    assert row["wind_direction"] == 12.0
    assert row["wind_speed"] is None and row["ceiling_height"] is None and row["visibility"] is None


@pytest.mark.parametrize("height,flags", [
    (None, (0, 0, 0)), (9999.0, (1, 0, 0)), (10000.0, (0, 1, 0)), (19999.0, (0, 1, 0)), (20000.0, (0, 0, 1)),
])
def test_ceiling_bands(spark, height, flags):
    row = weather.band_flags(spark.createDataFrame([(height,)], "ceiling_height double")).first()
    assert tuple(row)[1:] == flags


def test_special_codes(spark):
    codes = (None, "", "RA") + (None,) * 10
    df = spark.createDataFrame([codes], ", ".join(f"{c} string" for c in SPECIAL_WEATHER))
    counted = weather.present_count(df)
    assert counted.columns == ["specWeather"]
    assert counted.first()[0] == 1 and weather.binarise(counted).first()[0] == 1


def test_wind_bins(spark):
    rows = [(v, 1.0) for v in (0.0, 9.9, 10.0, 59.9, 60.0, None)]
    df = spark.createDataFrame(rows, "wind_speed double, DEP_DEL15 double")

    def bins(**how):
        table = breakdown.binned_breakdown(df, "wind_speed", **how)
        return {r["wind_speed_bin"]: (r["total_flights"], r["bin_label"]) for r in table.collect()}

    low = {0: (2, "0-10"), 10: (1, "10-20"), 50: (1, "50-60")}
    assert bins(cap=50, beyond="drop") == low
    rest = {k: v for k, v in bins().items() if k is not None}
    assert rest == {**low, 60: (1, "60-70")}
    capped = {k: v for k, v in bins(cap=10).items() if k is not None}
    assert capped == {0: (2, "0-10"), 10: (1, "10-20"), 20: (2, "20 and more")}


def test_join_form_fills_counts_only(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0), (None, 1.0), ("c", None)], "k string, DEP_DEL15 double")
    got = {r[0]: tuple(r[1:]) for r in breakdown.label_breakdown_joined(df, "k").collect()}
    assert got == {"a": (2, 0), "b": (0, 1), None: (1, 0)}
    flat = {r[0]: tuple(r[1:3]) for r in breakdown.label_breakdown(df, "k").collect()}
    assert flat == got
