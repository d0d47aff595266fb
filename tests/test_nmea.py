"""NMEA sentences to positions: bit fields, parts in any order, lost parts, noise, splits of a file."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vesselrisk.sources import nmea


def bits(value, n):
    return format(value % (1 << n), f"0{n}b")


def payload(mmsi=123456789, lat=1.3, lon=103.8, sog=5.0, cog=90.0, status=0, kind=1):
    place = bits(round(lon * 600000), 28) + bits(round(lat * 600000), 27) + bits(round(cog * 10), 12)
    head = bits(kind, 6) + "00" + bits(mmsi, 30)
    b = head + "0" * 8 + bits(round(sog * 10), 10) + "0" + place if kind == 18 else head + bits(status, 4) + "0" * 8 + bits(round(sog * 10), 10) + "0" + place
    b = b.ljust(168, "0")
    codes = [int(b[i : i + 6], 2) for i in range(0, 168, 6)]
    return "".join(chr(c + 48 if c < 40 else c + 56) for c in codes)


def read(spark, tmp_path, lines, name="feed.nmea", **how):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return nmea.read_nmea(spark, str(tmp_path), **how).orderBy("file", "line").collect()


def test_fields_of_both_classes(spark, tmp_path):
    lines = [f"!AIVDM,1,1,,A,{payload(status=5, lat=-1.25, lon=-77.5, sog=12.3, cog=359.9)},0*5C", f"!AIVDO,1,1,,B,{payload(mmsi=987654321, kind=18)},0*00"]
    a, b = read(spark, tmp_path, lines)
    assert (a.mmsi, a.nav_status) == ("123456789", 5)
    assert (a.lat, a.lon) == pytest.approx((-1.25, -77.5), abs=1e-6) and (a.sog, a.cog) == pytest.approx((12.3, 359.9), abs=1e-4)
    assert (b.mmsi, b.nav_status, b.ship_type) == ("987654321", 0, 0) and b.lat == pytest.approx(1.3, abs=1e-6)


def test_parts_out_of_order_lost_parts_and_noise(spark, tmp_path):
    p = [payload(mmsi=100000000 + i) for i in range(6)]

    def part(i, n, seq):
        return f"!AIVDM,2,{n},{seq},A,{p[i][:15] if n == 1 else p[i][15:]},0*00"

    lines = [
        part(0, 1, 3), part(1, 1, 4), "$GPGGA,1,2,3,4,5,6", part(1, 2, 4), part(0, 2, 3),  # woven into each other
        part(2, 2, 3), "# noise", part(2, 1, 3),  # reversed
        part(3, 1, 5), part(4, 1, 5), part(4, 2, 5),  # the second part of 3 never comes
        part(5, 2, 6), *["# far"] * 70, part(5, 1, 6),  # too far apart
    ]
    assert sorted(r.mmsi for r in read(spark, tmp_path, lines)) == ["100000000", "100000001", "100000002", "100000004"]


def test_malformed_lines_are_left_out(spark, tmp_path):
    good = payload()
    lines = [
        "", "!AIVDM,1,1,,A", f"!AIVDM,x,1,,A,{good},0*00", f"!AIVDM,1,1,,A,{good[:-1]}~,0*00", f"!AIVDM,1,1,,A,{good[:20]},0*00", f"!BSVDM,1,1,,A,{good},0*00",
        f"!AIVDM,1,1,,A,{payload(kind=5)},0*00", f"!AIVDM,1,1,,A,{payload(lat=91.0)},0*00", f"!AIVDM,1,1,,A,{payload(lon=181.0)},0*00",
        f"!AIVDM,1,1,,A,{good},9*00", f"!AIVDM,0,1,,A,{good},0*00", f"!aivdm,1,1,,A,{good},0",
    ]
    assert [r.mmsi for r in read(spark, tmp_path, lines)] == ["123456789"]


def test_times_and_box(spark, tmp_path):
    lines = [f"2024-01-15T10:30:00Z,!AIVDM,1,1,,A,{payload()},0*00", f"!AIVDM,1,1,,A,{payload(lat=35.0, lon=139.0)},0*00", f"!AIVDM,1,1,,A,{payload()},0*00"]
    at = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)
    one, two = read(spark, tmp_path, lines, bbox=(-5, 92, 22, 122), received_at=at)
    times = nmea.read_nmea(spark, str(tmp_path), received_at=at).selectExpr("date_format(timestamp, 'yyyy-MM-dd HH:mm:ss.SSS') AS t").collect()
    assert sorted(r.t for r in times) == ["2024-01-15 10:30:00.000", "2024-02-01 00:00:00.001", "2024-02-01 00:00:00.002"]
    assert one.line == 0 and two.line == 2


def test_files_are_apart_and_splits_are_not(spark, tmp_path):
    """Parts of two files never meet; a file read in many splits has the same messages."""
    p = payload()
    for name in ("a", "b"):
        (tmp_path / f"{name}.nmea").write_text(f"!AIVDM,2,{1 if name == 'a' else 2},1,A,{p[:15] if name == 'a' else p[15:]},0*00\n")
    assert nmea.read_nmea(spark, str(tmp_path)).count() == 0
    many = tmp_path / "many"
    many.mkdir()
    lines = []
    for i in range(400):
        own = payload(mmsi=200000000 + i)
        lines += [f"!AIVDM,2,1,{i % 10},A,{own[:15]},0*00", f"!AIVDM,2,2,{i % 10},A,{own[15:]},0*00"]
    (many / "x.nmea").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = nmea.read_nmea(spark, str(many), reach=8)
        assert got.select("mmsi").distinct().count() == got.count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bits_are_read_without_a_step_a_character(spark):
    """payloads are base 64 in other characters; no lambda over their characters, same values."""
    rng = random.Random(4)
    values = [[rng.randrange(2) for _ in range(168)] for _ in range(40)]
    armour = lambda v: chr(v + (48 if v < 40 else 56))
    rows = [("".join(map(str, v)), "".join(armour(int("".join(map(str, v[i:i + 6])), 2)) for i in range(0, 168, 6))) for v in values]
    df = spark.createDataFrame([*rows, (None, "")], "bits string, payload string").withColumn("hex", nmea.unarmoured(F.col("payload")))
    fields = [*nmea.CLASS_A.values(), *nmea.CLASS_B.values(), (8, 30), (0, 6)]
    got = df.select("bits", "payload", nmea.armoured(F.col("bits"), 28).alias("coded"), *[nmea.unsigned(F.col("hex"), *f).alias(f"u{i}") for i, f in enumerate(fields)],
                    *[nmea.signed(F.col("hex"), *f).alias(f"s{i}") for i, f in enumerate(fields)])
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    for r in got.collect():
        assert r.coded == r.payload
        for i, (at, n) in enumerate(fields if r.bits else []):
            v = int(r.bits[at:at + n], 2)
            assert (r[f"u{i}"], r[f"s{i}"]) == (v, v - (v >> (n - 1) << n))
