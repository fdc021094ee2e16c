"""Time and address columns against Python's own implementations."""

import ipaddress
import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetide.functions import histogram, ip, times
from pagetide.operators.events import with_canonical_ip


def values(spark, texts, sql):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r.v for r in rows.selectExpr("i", f"{sql} AS v").orderBy("i").collect()]


@pytest.mark.parametrize(
    "text, instant",
    [
        ("2024-01-30T10:20:30Z", "2024-01-30 10:20:30"),
        ("2024-01-30T10:20:30.123456789Z", "2024-01-30 10:20:30.123456"),
        ("2024-01-30T10:20:30+03:00", "2024-01-30 07:20:30"),
        ("2024-01-30T10:20:30.25-23:59", "2024-01-31 10:19:30.25"),
        ("2024-02-29T00:00:00Z", "2024-02-29 00:00:00"),
        ("2023-02-29T00:00:00Z", None),
        ("2024-01-30T10:20:60Z", None),
        ("2024-01-30T10:20:30+24:00", None),
        ("2024-01-30T10:20:30.Z", None),
        ("2024-01-30T10:20:30", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_rfc3339(spark, text, instant):
    got = values(spark, [text], "CAST(" + times.parse_rfc3339("s") + " AS STRING)")
    assert got == [instant]


def test_rfc3339_round_trip(spark):
    rnd = random.Random(3)
    base = datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = [rnd.randrange(4 * 10**15) for _ in range(300)] + [0, 10**6, 1500000]
    texts = [(base + timedelta(microseconds=m)).isoformat().replace("+00:00", "Z") for m in micros]
    assert values(spark, texts, "unix_micros(" + times.parse_rfc3339("s") + ")") == micros
    shown = values(spark, texts, times.format_rfc3339(times.parse_rfc3339("s")))
    for text, out in zip(texts, shown):
        assert out == (text[:-1].rstrip("0").rstrip(".") + "Z" if "." in text else text)


@pytest.mark.parametrize(
    "text, shown",
    [
        ("2024-01-15T12:00:00.120Z", "2024-01-15 12:00:00.12 +0000 UTC"),
        ("2024-01-15T12:00:00.000Z", "2024-01-15 12:00:00 +0000 UTC"),
        ("2024-01-15T12:00:00.1234567891Z", "2024-01-15 12:00:00.123456789 +0000 UTC"),
        ("2024-01-15T12:00:00+00:00", "2024-01-15 12:00:00 +0000 UTC"),
        ("2024-01-15T12:00:00.5-03:30", "2024-01-15 12:00:00.5 -0330 -0330"),
        (None, "0001-01-01 00:00:00 +0000 UTC"),
    ],
)
def test_display_time(spark, text, shown):
    assert values(spark, [text], times.display_time("s")) == [shown]


def test_buckets(spark):
    ts = F.col("s").cast("timestamp")
    row = (
        spark.createDataFrame([("2024-01-31 05:59:59.999",)], "s string")
        .select(
            times.minute(ts).cast("string").alias("minute"),
            times.hour(ts).cast("string").alias("hour"),
            times.month(ts).alias("month"),
            times.traffic_period(ts).alias("period"),
        )
        .first()
    )
    assert tuple(row) == ("2024-01-31 05:59:00", "2024-01-31 05:00:00", 202401, "night")


def canonical_by_python(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return ip.UNKNOWN
    if "%" in text:
        return ip.UNKNOWN
    if address.version == 4:
        return f"::ffff:{address}"
    if address.ipv4_mapped:
        return f"::ffff:{address.ipv4_mapped}"
    return str(address)


def check_addresses(spark, texts):
    rows = spark.createDataFrame([(t, t) for t in texts], "text string, ip_address string")
    got = {r.text: r.ip_address for r in with_canonical_ip(rows).collect()}
    assert {t: c for t, c in got.items() if c != canonical_by_python(t)} == {}


def test_address_forms(spark):
    check_addresses(
        spark,
        ["", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8"]
        + ["1::3:4:5:6:7:8", "1:2::3:4:5:6:7:8", "::ffff:1.2.3.4", "::FFFF:0102:0304"]
        + ["64:ff9b::1.2.3.4", "1.2.3", "01.2.3.4", "1.2.3.4.5", "256.1.1.1", "255.255.255.255"]
        + ["fe80::1%eth0", ":::", "1:::2", "12345::", "::1.2.3.04", "1.2.3.4\n", "::1\n", "g::"]
        + ["1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", " ::1", "0:0:1:0:0:0:1:0", "not-an-ip"],
    )


def test_random_addresses(spark):
    rnd = random.Random(11)
    texts = set()
    for _ in range(1500):
        groups = [rnd.choice([0, 0, 0, rnd.randrange(16), rnd.randrange(65536)]) for _ in range(8)]
        full = ":".join(rnd.choice(["%x", "%04x", "%X", "%04X"]) % g for g in groups)
        at = rnd.randrange(len(full))
        i = rnd.randrange(8)
        j = rnd.randrange(i, 9)
        short = ["%x" % g for g in groups]
        texts |= {full, full[:at] + rnd.choice(":.0fg%") + full[at + 1 :]}
        texts.add(":".join(short[:i]) + "::" + ":".join(short[j:]))
        texts.add(".".join(str(rnd.randrange(300)) for _ in range(4)))
    check_addresses(spark, sorted(texts))


@given(st.floats(0.001, 10), st.floats(1.1, 4), st.integers(1, 20))
@settings(max_examples=30, deadline=None)
def test_exponential_edges_rise(start, factor, count):
    edges = histogram.exponential_edges(start, factor, count)
    assert len(edges) == count and edges == sorted(set(edges)) and edges[0] == start


def test_edges():
    assert histogram.linear_edges(10, 10, 3) == [10, 20, 30]
    assert histogram.exponential_edges(0.01, 2, 3) == [0.01, 0.02, 0.04]
    for bad in (lambda: histogram.linear_edges(0, 0, 3), lambda: histogram.exponential_edges(0, 2, 3)):
        with pytest.raises(ValueError):
            bad()
