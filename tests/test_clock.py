from datetime import datetime, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.functions import clock


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp()) * 1_000_000


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2025-09-25T18:05:12Z", us(2025, 9, 25, 18, 5, 12)),
        ("2025-09-25T18:05:12+03:00", us(2025, 9, 25, 15, 5, 12)),
        ("2025-09-25T18:05:12-05:00", us(2025, 9, 25, 23, 5, 12)),
        ("2025-09-25T18:05:12+0300", us(2025, 9, 25, 15, 5, 12)),
        ("2025-09-25T18:05:12", us(2025, 9, 25, 18, 5, 12)),
        ("2025-09-25T18:05:12.123456789Z", us(2025, 9, 25, 18, 5, 12) + 123456),
        ("  2025-09-25T18:05:12.5Z ", us(2025, 9, 25, 18, 5, 12) + 500000),
    ],
)
def test_iso_accepted(text, want):
    assert clock.iso_micros(text) == want


@pytest.mark.parametrize("text", ["", " ", "hello", "2025/09/25T18:05:12Z", "2025-9-25T18:05:12Z", "2025-09-25 18:05:12", "2025-13-25T18:05:12Z", "2025-09-32T18:05:12Z", "2025-02-30T00:00:00Z", "2025-01-01T24:00:00Z", "2025-01-01T23:59:60Z", "2025-01-01T00:00:00+19:00", "٢٠٢٥-01-01T00:00:00Z"])
def test_iso_rejected(text):
    assert clock.iso_micros(text) is None


@pytest.mark.parametrize(
    ("text", "zone", "want"),
    [
        ("1749044255", None, 1749044255_000000),
        ("1749044255.911", None, 1749044255_911000),
        ("1749044255911", None, 1749044255_911000),
        ("1749044255911123", None, 1749044255_911123),
        ("1749044255911123999", None, 1749044255_911123),
        ("20250116201447", None, us(2025, 1, 16, 20, 14, 47)),
        ("20250322T064424Z", "Europe/Berlin", us(2025, 3, 22, 6, 44, 24)),
        ("28.01.2025 16:08:16", "Europe/Berlin", us(2025, 1, 28, 15, 8, 16)),
        ("Fri, 31 May 2024 12:20:05 +0545", None, us(2024, 5, 31, 6, 35, 5)),
        ("Thu, 19 Dec 2024 12:55:38 GMT", "Asia/Kolkata", us(2024, 12, 19, 12, 55, 38)),
        ("12 Dec 2025 09:04:32", None, us(2025, 12, 12, 9, 4, 32)),
        ("26-SEP-2024 05:09", None, us(2024, 9, 26, 5, 9)),
        ("27-JULY-2025 20:49", None, us(2025, 7, 27, 20, 49)),
        ("Oct 10, 2025 3:44:09 AM", None, us(2025, 10, 10, 3, 44, 9)),
        ("May 25, 2024 12:44:04 PM", None, us(2024, 5, 25, 12, 44, 4)),
        ("2024-03-26T08:25:31+05:30[Asia/Kolkata]", "Europe/Berlin", us(2024, 3, 26, 2, 55, 31)),
        ("2025-02-28 01:26:10 America/Chicago", None, us(2025, 2, 28, 7, 26, 10)),
        ("2025-04-17t06:00:12.550z", None, us(2025, 4, 17, 6, 0, 12) + 550000),
        ("2025-03-01 14:03:06,948", None, us(2025, 3, 1, 14, 3, 6) + 948000),
        ("2024-02-25T17:53", None, us(2024, 2, 25, 17, 53)),
        # summer time: twice on the clock is the earlier instant, a skipped time moves on by the gap
        ("2024-10-27 02:30:00", "Europe/Berlin", us(2024, 10, 27, 0, 30)),
        ("2024-03-31 02:30:00", "Europe/Berlin", us(2024, 3, 31, 1, 30)),
        ("2024-04-07 02:30:00", "Australia/Adelaide", us(2024, 4, 6, 16, 0)),
    ],
)
def test_notations(text, zone, want):
    _, day, month = clock.interpretations(text, zone)
    assert day == month == want


def test_numeric_dates_have_two_readings():
    assert clock.interpretations("04/12/2024 10:21:53", None)[1:] == (us(2024, 12, 4, 10, 21, 53), us(2024, 4, 12, 10, 21, 53))
    assert clock.interpretations("13/06/2025 02:58am", None)[1:] == (us(2025, 6, 13, 2, 58), None)
    assert clock.interpretations("06-13-2025 02:58", None)[1:] == (None, us(2025, 6, 13, 2, 58))


@pytest.mark.parametrize("text", ["-", "not set", "2025-03-14", "2025-W09", "18:05:12", "31/31/2025 10:00:00", "32.01.2025 10:00", "2025-06-15T24:61:00Z", "ref 12345", "0000-00-00 00:00:00", "12 Foo 2025 09:04:32", "Oct 10, 2025 13:44:09 AM", "x" * 100_000])
def test_unreadable(text):
    assert clock.interpretations(text, None)[1:] == (None, None)


@given(st.datetimes(min_value=datetime(1700, 1, 1), max_value=datetime(2400, 1, 1)))
def test_round_trip(d):
    text = d.strftime("%Y-%m-%d %H:%M:%S.%f")
    want = int((d - datetime(1970, 1, 1)).total_seconds() // 1) * 1_000_000 + d.microsecond
    assert clock.interpretations(text, None)[1] == want


def test_unknown_zone_is_unreadable():
    assert clock.interpretations("2025-02-28 01:26:10", "No/Where")[1] is None
    assert clock.local_micros(5, " ") == 5
