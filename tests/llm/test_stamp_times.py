import random
import re
from collections import Counter
from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest

from gleanmill.llm import registry, stamp_times
from tests.conftest import DATA, rows_of, same_rows

ZONES = ["UTC", "Europe/Berlin", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "America/Santiago", "Pacific/Apia", "Africa/Casablanca"]
SCHEMA = "stamp_id long, source string, zone string, raw string"
CLOCK = r"(?:[T ](\d\d):(\d\d)(?::(\d\d))?(?: ?([AP])M)?(?: ?(Z|[+-]\d\d:?\d\d))?)?"
FORMS = [
    (r"(?P<y>20\d\d)-(?P<m>\d\d)-(?P<d>\d\d)", False), (r"(?P<y>20\d\d)(?P<m>\d\d)(?P<d>\d\d)", False), (r"(?P<d>\d\d)\.(?P<m>\d\d)\.(?P<y>20\d\d)", False),
    (r"(?P<d>\d\d) (?P<m>Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (?P<y>20\d\d)", False), (r"(?P<d>\d\d)/(?P<m>\d\d)/(?P<y>20\d\d)", True),
]


def day(y, m, d):
    try:
        return date(int(y), stamp_times.MONTHS.index(m) + 1 if m.isalpha() else int(m), int(d))
    except ValueError:
        return None


def read(raw, zone):
    """None, an epoch in microseconds, or (days that it may mean, seconds of the day, offset)."""
    t = (raw or "").strip("\t\n\x0b\x0c\r ")
    if re.fullmatch("[0-9]{10}|[0-9]{13}", t):
        return int(t) * (1_000_000 if len(t) == 10 else 1000)
    for form, slashed in FORMS:
        if m := re.fullmatch(form + CLOCK, t, re.ASCII):
            days = [day(m["y"], m["m"], m["d"])] + ([day(m["y"], m["d"], m["m"])] if slashed else [])
            h, mi, s, half, off = m.groups()[3:]
            h, mi, s = int(h or 0), int(mi or 0), int(s or 0)
            if half:
                if not 1 <= h <= 12:
                    return None
                h = h % 12 + 12 * (half == "P")
            shift = None
            if off:
                digits = off.replace(":", "")
                shift = 0 if off == "Z" else (int(digits[1:3]) * 3600 + int(digits[3:5]) * 60) * (-1 if digits[0] == "-" else 1)
                if off != "Z" and (int(digits[1:3]) > 14 or int(digits[3:5]) > 59):
                    return None
            elif zone not in ZONES:
                return None
            if h > 23 or mi > 59 or s > 59 or not any(days):
                return None
            return days, h * 3600 + mi * 60 + s, shift
    return None


def instants(wall, zone):
    """Instants that show this wall time, by trying all offsets that the zone has near it."""
    z = ZoneInfo(zone)
    near = {(wall + timedelta(hours=h)).replace(tzinfo=UTC).astimezone(z).utcoffset() for h in range(-48, 49)}
    return sorted(wall - o for o in near if (wall - o).replace(tzinfo=UTC).astimezone(z).replace(tzinfo=None) == wall)


def by_hand(rows):
    seen, votes = {}, Counter()
    for i, source, zone, raw in rows:
        x = seen[i] = read(raw, zone)
        if isinstance(x, tuple) and len(x[0]) == 2 and (x[0][0] is None) != (x[0][1] is None):
            votes[source, x[0][0] is None] += 1
    out = []
    for i, source, zone, _ in rows:
        x = seen[i]
        if x is None or isinstance(x, int):
            out.append((i, x, "bad" if x is None else "epoch", False))
            continue
        days, seconds, shift = x
        rule, chosen = "plain", next(d for d in days if d)
        if len(days) == 2 and all(days) and days[0] != days[1]:
            first, turned = votes[source, False], votes[source, True]
            rule = "votes" if first > 10 * turned or turned > 10 * first else "default"
            chosen = days[1] if turned > 10 * first else days[0]
        wall, odd = datetime(chosen.year, chosen.month, chosen.day) + timedelta(seconds=seconds), False
        if shift is not None:
            at = wall - timedelta(seconds=shift)
        else:
            found = instants(wall, zone)
            odd = len(found) != 1
            z = ZoneInfo(zone)
            after = (wall + timedelta(days=1)).replace(tzinfo=UTC).astimezone(z).utcoffset()
            at = found[0] if len(found) == 1 else wall - after
        out.append((i, (at - datetime(1970, 1, 1)) // timedelta(microseconds=1), rule, rule != "plain" or odd))
    return out


def made(n, seed, sources):
    r = random.Random(seed)
    out = []
    for i in range(n):
        source, zone = r.choice(sources), r.choice([*ZONES, *ZONES, None, "No/Where"])
        y, m, d, h, mi, s = r.randint(2000, 2099), r.randint(1, 12 + (r.random() < 0.1)), r.randint(1, 31), r.randint(0, 24 if r.random() < 0.1 else 23), r.randint(0, 60 if r.random() < 0.1 else 59), r.randint(0, 59)
        if r.random() < 0.5:  # days on which offsets change
            y, m, d, h = r.choice([(2024, 3, 31, 2), (2024, 10, 27, 2), (2024, 3, 10, 2), (2024, 11, 3, 1), (2011, 12, 30, 5), (2024, 4, 7, 1), (2024, 10, 6, 2), (2024, 9, 8, 0), (2024, 4, 6, 23), (2024, 3, 10, 2), (2050, 3, 27, 2)])
        form = r.choice(["{y}-{m:02}-{d:02}", "{y}{m:02}{d:02}", "{d:02}.{m:02}.{y}", "{d:02} {b} {y}", "{d:02}/{m:02}/{y}", "{m:02}/{d:02}/{y}", "{d:02}/{m:02}/{y}"])
        if source in ("us", "s1"):
            form = form.replace("{d:02}/{m:02}", "{m:02}/{d:02}")
        if source == "eu":
            form = form.replace("{m:02}/{d:02}", "{d:02}/{m:02}")
        half = r.random() < 0.2
        clock = r.choice(["", "T{h:02}:{mi:02}", " {h:02}:{mi:02}:{s:02}"])
        if clock:
            clock += (r.choice([" ", ""]) + r.choice(["AM", "PM"]) if half else "") + (r.choice(["", " "]) + r.choice(["Z", "+05:30", "-0800", "+15:00", "+14:59", "-02:60"]) if r.random() < 0.2 else "")
        raw = (form + clock).format(y=y, m=m, d=d, h=r.randint(0, 13) if half else h, mi=mi, s=s, b=stamp_times.MONTHS[m - 1 if m < 13 else 0])
        raw = r.choice([raw] * 8 + [f" {raw}\t", raw[:-2], str(r.randint(10**9, 10**10 - 1)), str(r.randint(10**12, 10**13 - 1)), "", "n/a", None, "  ", raw.lower(), raw + " ", "12345678901"])
        out.append((i, source, zone, raw))
    return out


def test_against_brute_force_and_sql(spark, tmp_path):
    import duckdb

    rows = made(4000, 1, ["us", "eu", "mixed", None, "", "s1"])
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/stamps.parquet")
    got = stamp_times.op12_timestamp_normalisation(spark, str(tmp_path))
    names = ["stamp_id", "utc_us", "rule", "ambiguous"]
    want = by_hand(rows)
    found = {r[0]: tuple(r) for r in got.select(*names).collect()}
    assert len(found) == len(rows)
    assert [(found[w[0]], rows[w[0]]) for w in want if found[w[0]] != w] == []
    assert {w[2] for w in want} == {"bad", "epoch", "votes", "default", "plain"} and sum(w[3] and w[2] == "plain" for w in want) > 30
    # SQL has its own copy of the time zone database, whose future of Morocco differs.
    db = duckdb.connect()
    db.sql(f"CREATE VIEW every AS SELECT * FROM '{tmp_path}/stamps.parquet/*.parquet'")
    db.sql("CREATE VIEW stamps AS SELECT * FROM every WHERE zone IS DISTINCT FROM 'Africa/Casablanca'")
    rest = spark.read.parquet(f"{tmp_path}/stamps.parquet").filter("zone IS DISTINCT FROM 'Africa/Casablanca'")
    same_rows(stamp_times.normalised(rest), db.sql(stamp_times.ORACLE_SQL))


def test_sources_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(stamp_times, "HOT", 4)
    rows = made(3000, 2, ["us", "us", "us", "mixed", *[f"s{i}" for i in range(60)], None])
    got = stamp_times.normalised(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert rows_of(got, ["stamp_id", "utc_us", "rule", "ambiguous"]) == rows_of(spark.createDataFrame(by_hand(rows), "stamp_id long, utc_us long, rule string, ambiguous boolean"), ["stamp_id", "utc_us", "rule", "ambiguous"])


def test_edges(spark):
    rows = [
        (1, "a", "UTC", "01/02/2024"), (1, "a", "UTC", "01/02/2024"), (2, "a", "UTC", "05/05/2024"), (3, "a", None, "2024-01-01T00:00Z"), (4, "a", None, "2024-01-01"), (5, "a", "x", "1704067200"),
        (6, "b", "UTC", "31/12/2024"), (7, "b", "UTC", "03/04/2024"), (8, "c", "UTC", "12/31/2024 12:00 AM"), (9, "c", "UTC", "03/04/2024 12:00PM"), (10, "c", "bad", "31/01/2024"), (None, None, None, None),
        (11, "d", "UTC", "2024-02-30"), (12, "d", "UTC", "2024-01-01T24:00"), (13, "d", "UTC", "2024-01-01 10:00 +0530"), (14, "d", "UTC", "x" * 100_000), (15, "d", "UTC", "#|2024|01||01||||||"), (16, "d", "UTC", "2024-01-01\n2024-01-01"),
    ]
    frame = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA + ", rule string, low long, day_votes long")
    found = {r.stamp_id: (r.utc_us, r.rule, r.ambiguous) for r in stamp_times.normalised(frame).collect()}
    second, day = 1_000_000, 86_400_000_000
    new_year = 1704067200 * second
    assert found[1] == (new_year + 31 * day, "default", True) and found[2][1:] == ("plain", False) and found[3] == (new_year, "plain", False)
    assert found[4] == (None, "bad", False) and found[5] == (new_year, "epoch", False) and found[7] == (new_year + (31 + 29 + 31 + 2) * day, "votes", True)
    assert found[8][1:] == ("plain", False) and found[9] == (new_year + (31 + 29 + 3) * day + day // 2, "votes", True) and found[13] == (new_year + 16200 * second, "plain", False)
    assert all(found[i] == (None, "bad", False) for i in (None, 10, 11, 12, 14, 15, 16))
    assert stamp_times.normalised(frame).count() == len(rows) and not stamp_times.normalised(frame.limit(0)).collect()


@pytest.mark.parametrize("zone", ZONES)
def test_intervals_cover_every_wall_time_once(zone):
    spans = sorted(stamp_times.intervals(zone), key=lambda x: x[2])
    assert all(a[3] == b[2] for a, b in zip(spans, spans[1:], strict=False)) and len(spans) <= 700
    assert spans[0][2] == datetime(2000, 1, 1, tzinfo=UTC).timestamp() and spans[-1][3] == datetime(2100, 1, 1, tzinfo=UTC).timestamp()
    assert all(datetime.fromtimestamp(s[2], UTC).year == datetime.fromtimestamp(s[3] - 1, UTC).year == s[1] for s in spans)


def test_registered(spark, duck):
    same_rows(registry.queries()["op12_timestamp_normalisation"](spark, DATA), duck.sql(registry.oracle_sql()["op12_timestamp_normalisation"]))
