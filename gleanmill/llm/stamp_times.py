"""Mixed timestamp normalisation: native parsing, votes on day and month, wall times by interval.

A stamp is parsed by column expressions. The wall time of a zone is one table of
intervals: each zone's timeline is split where its offset changes into normal
stretches, gaps that clocks skip and overlaps that they repeat, each with the
offset before and after, cut at year ends so that a row meets only the
few intervals of its zone and year. Its size is bounded by the time zone
database (under 600 names, 100 years, some five intervals each), so it is broadcast and
joined by range.

Slashed dates that fit only one order vote for it in their source. Votes are
summed per source; sources with more than 1/``HOT`` of the rows that ask are at
most ``HOT`` and broadcast, all other sources are joined by a shuffle.

Defined results: null, impossible and other stamps are bad, with no time, and
so is a date without offset whose zone is null or unknown; nothing of them votes. A
null source is a source of its own. Repeated rows get equal results; an empty table gives
an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from datetime import UTC, datetime
from zoneinfo import ZoneInfo, available_timezones

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.frames import kept
from gleanmill.session import ensure_checkpoint_dir, table

#: At most so many sources are broadcast: those with more than this share of the rows that ask for votes.
HOT = 512
#: An order wins over the other with more than so many times its votes.
WINS = 10
YEARS = range(2000, 2100)
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WHITE = "\t\n\x0b\x0c\r "
_DAY = 86_400
#: No zone changes its offset twice within so many days.
_APART = 3

_STAMP = (
    r"\A(?:(20[0-9]{2})-([0-9]{2})-([0-9]{2})|(20[0-9]{2})([0-9]{2})([0-9]{2})|([0-9]{2})\.([0-9]{2})\.(20[0-9]{2})"
    rf"|([0-9]{{2}}) ({'|'.join(MONTHS)}) (20[0-9]{{2}})|([0-9]{{2}})/([0-9]{{2}})/(20[0-9]{{2}}))"
    r"(?:[T ]([0-9]{2}):([0-9]{2})(?::([0-9]{2}))?(?: ?([AP])M)?(?: ?(Z|[+-][0-9]{2}:?[0-9]{2}))?)?\z"
)
#: Groups of the pattern in a fixed order: year, month, its name, day, first and second of a slashed date, hour, minute, second, A or P, offset.
_GROUPS = "$1$4$9$12$15|$2$5$8|$11|$3$6$7$10|$13|$14|$16|$17|$18|$19|$20"


def _offset(zone: ZoneInfo, second: int) -> int:
    return int(datetime.fromtimestamp(second, UTC).astimezone(zone).utcoffset().total_seconds())


def changes(name: str) -> list[tuple[int, int, int]]:
    """(instant, offset before, offset after) of a zone in the years that stamps can have, in seconds."""
    zone = ZoneInfo(name)
    start, stop = (int(datetime(y, m, d, tzinfo=UTC).timestamp()) for y, m, d in ((YEARS[0] - 1, 12, 25), (YEARS[-1] + 1, 1, 7)))
    found, before = [], _offset(zone, start)
    for at in range(start, stop, _APART * _DAY):
        after = _offset(zone, at + _APART * _DAY)
        if after != before:
            first = at + bisect_left(range(_APART * _DAY), True, key=lambda s, at=at, after=after: _offset(zone, at + s) == after)
            found.append((first, before, after))
            before = after
    return found


def intervals(name: str) -> list[tuple[str, int, int, int, int, int, str]]:
    """(zone, year, from, to, offset before, offset after, kind) over all wall times, in seconds, cut at year ends."""
    year = {y: int(datetime(y, 1, 1, tzinfo=UTC).timestamp()) for y in [*YEARS, YEARS[-1] + 1]}
    pieces, since = [], -(1 << 60)
    told = changes(name)
    for at, before, after in told:
        low, high = sorted((at + before, at + after))
        pieces += [(since, low, before, before, "normal"), (low, high, before, after, "gap" if after > before else "overlap")]
        since = high
    last = told[-1][2] if told else _offset(ZoneInfo(name), year[YEARS[0]])
    pieces.append((since, 1 << 60, last, last, "normal"))
    return [
        (name, y, max(low, year[y]), min(high, year[y + 1]), before, after, kind)
        for low, high, before, after, kind in pieces
        for y in range(max(YEARS[0], datetime.fromtimestamp(max(low, year[YEARS[0]]), UTC).year), YEARS[-1] + 1)
        if low < year[y + 1] and high > year[y]
    ]


def interval_table(spark: SparkSession, zones: list[str]) -> DataFrame:
    """Wall-time intervals of the given zones as a table."""
    rows = [row for name in sorted(zones) for row in intervals(name)]
    kinds = {"zone": pa.string(), "year": pa.int32(), "low": pa.int64(), "high": pa.int64(), "before": pa.int32(), "after": pa.int32(), "kind": pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return spark.createDataFrame(pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, kinds.items(), strict=True)}))


def known_zones(stamps: DataFrame) -> list[str]:
    """Zones of the table that the time zone database has; no more than it has names."""
    names = sorted(available_timezones())
    return sorted(r[0] for r in stamps.select("zone").filter(F.col("zone").isin(names)).distinct().collect())


def _days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970 of a date; null if there is no such day."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    length = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    real = month.between(1, 12) & (day >= 1) & (day <= length)
    return F.when(real, F.unix_date(F.make_date(year, month, day)).cast("long"))


def parsed(stamps: DataFrame, zones: list[str]) -> DataFrame:
    """stamp_id, source, zone; epoch_us; day_first and month_first (days since 1970), seconds of the day, offset; bad."""
    raw = F.btrim(F.col("raw"), F.lit(WHITE))
    rows = stamps.select("stamp_id", "source", "zone", raw.alias("text"))
    rows = rows.select("*", F.when(F.col("text").rlike(_STAMP), F.split(F.regexp_replace("text", F.lit(_STAMP), F.lit(_GROUPS)), r"\|")).alias("part"))
    part = dict(zip(["year", "month", "name", "day", "first", "second", "hour", "minute", "sec", "half", "offset"], (F.nullif(F.col("part")[i], F.lit("")) for i in range(11)), strict=True))
    number = {k: part[k].cast("int") for k in ("year", "month", "day", "first", "second", "hour", "minute", "sec")}
    named = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), part["name"]), F.lit(0)).cast("int")
    plain = _days(number["year"], F.coalesce(number["month"], named), number["day"])
    hour = F.when(part["half"].isNull(), F.when(number["hour"] <= 23, number["hour"])).when(number["hour"].between(1, 12), number["hour"] % 12 + F.when(part["half"] == "P", 12).otherwise(0))
    seconds = F.when(number["hour"].isNull(), 0).when((number["minute"] <= 59) & (F.coalesce(number["sec"], F.lit(0)) <= 59), hour * 3600 + number["minute"] * 60 + F.coalesce(number["sec"], F.lit(0)))
    digits = F.replace(part["offset"], F.lit(":"), F.lit(""))
    ahead = F.when(part["offset"] == "Z", 0)
    hours, minutes = F.substring(digits, 2, 2).cast("int"), F.substring(digits, 4, 2).cast("int")
    shift = (hours * 3600 + minutes * 60) * F.when(F.startswith(digits, F.lit("-")), -1).otherwise(1)
    ahead = ahead.when(part["offset"].isNotNull() & (hours <= 14) & (minutes <= 59), shift)
    epoch = F.when(F.col("text").rlike(r"\A[0-9]{10}\z"), F.col("text").cast("long") * 1_000_000).when(F.col("text").rlike(r"\A[0-9]{13}\z"), F.col("text").cast("long") * 1000)
    rows = rows.select(
        "stamp_id", "source", "zone", epoch.alias("epoch_us"), seconds.cast("long").alias("seconds"), ahead.cast("long").alias("ahead"), part["offset"].isNotNull().alias("has_offset"),
        F.coalesce(plain, _days(number["year"], number["second"], number["first"])).alias("day_first"),
        F.coalesce(plain, _days(number["year"], number["first"], number["second"])).alias("month_first"),
    )
    placed = F.when(F.col("has_offset"), F.col("ahead").isNotNull()).otherwise(F.coalesce(F.col("zone").isin(zones), F.lit(False)) if zones else F.lit(False))
    good = F.col("epoch_us").isNotNull() | (F.col("seconds").isNotNull() & F.coalesce("day_first", "month_first").isNotNull() & placed)
    return rows.withColumn("bad", ~good)


def votes(rows: DataFrame) -> DataFrame:
    """source, day_votes, month_votes, asking: rows possible in one order vote, rows possible in both ask; sources that nobody asks for are left out."""
    one = lambda a, b: (~F.col("bad") & F.col(a).isNotNull() & F.col(b).isNull()).cast("long")
    summed = rows.groupBy("source").agg(F.sum(one("day_first", "month_first")).alias("day_votes"), F.sum(one("month_first", "day_first")).alias("month_votes"), F.sum(_asks().cast("long")).alias("asking"))
    return summed.filter("asking > 0")


def _asks() -> Column:
    return ~F.col("bad") & F.coalesce(F.col("day_first") != F.col("month_first"), F.lit(False))


def with_votes(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Rows with day_votes and month_votes where they ask for them; each row once."""
    total = told.agg(F.sum("asking")).first()[0] or 0
    renamed = told.select(F.col("source").alias("voted"), "day_votes", "month_votes", "asking")
    hot, cold = (renamed.filter(c).drop("asking") for c in (F.col("asking") * HOT > total, F.col("asking") * HOT <= total))
    # At most HOT - 1 sources have more than 1/HOT of the rows.
    joined = rows.join(F.broadcast(hot), _asks() & rows["source"].eqNullSafe(F.col("voted")), "left")
    settled = joined.filter(~_asks() | F.col("day_votes").isNotNull()).drop("voted")
    rest = rows.filter(_asks()).join(F.broadcast(hot.select("voted")), rows["source"].eqNullSafe(F.col("voted")), "left_anti")
    return settled.unionByName(rest.join(cold.hint("merge"), rest["source"].eqNullSafe(F.col("voted"))).drop("voted"))


def normalised(stamps: DataFrame) -> DataFrame:
    """stamp_id, utc_us, rule, ambiguous of every stamp (stamp_id, source, zone, raw)."""
    spark = stamps.sparkSession
    ensure_checkpoint_dir(spark)
    stamps = stamps.select("stamp_id", *[F.col(c).cast("string").alias(c) for c in ("source", "zone", "raw")])
    zones = known_zones(stamps)
    told = kept(votes(parsed(stamps.filter(F.contains("raw", F.lit("/"))), zones)))
    rows = with_votes(parsed(stamps, zones), told)
    day, month = F.col("day_votes"), F.col("month_votes")
    turned = month > WINS * day
    rule = F.when(F.col("bad"), "bad").when(F.col("epoch_us").isNotNull(), "epoch").when(~_asks(), "plain").when(turned | (day > WINS * month), "votes").otherwise("default")
    date = F.when(_asks(), F.when(turned, F.col("month_first")).otherwise(F.col("day_first"))).otherwise(F.coalesce("day_first", "month_first"))
    wall = F.when(~F.col("bad") & F.col("epoch_us").isNull(), date * _DAY + F.col("seconds"))
    rows = rows.select("stamp_id", "epoch_us", "ahead", rule.alias("rule"), wall.alias("wall"), F.when(~F.col("has_offset"), F.col("zone")).alias("place"))
    year = F.year(F.date_from_unix_date(F.floor(F.col("wall") / _DAY).cast("int")))
    known = interval_table(spark, zones)
    spans = F.broadcast(known)
    met = (F.col("place") == known["zone"]) & (F.col("year_of") == known["year"]) & (F.col("wall") >= known["low"]) & (F.col("wall") < known["high"])
    rows = rows.withColumn("year_of", year).join(spans, met, "left")
    utc = F.coalesce("epoch_us", (F.col("wall") - F.coalesce("ahead", "after")) * 1_000_000)
    odd = F.coalesce(F.col("kind") != "normal", F.lit(False))
    return rows.select("stamp_id", F.when(F.col("rule") != "bad", utc).alias("utc_us"), "rule", (F.col("rule").isin("votes", "default") | odd).alias("ambiguous"))


def op12_timestamp_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instant of every stamp."""
    return normalised(table(spark, sf_dir, "stamps"))


#: Offsets here come from the instants a day before and after a wall time, not from a table of intervals.
ORACLE_SQL = r"""
WITH s AS (SELECT stamp_id, source, zone, trim(raw, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS t FROM stamps),
w AS (SELECT *, regexp_extract(t, '([T ][0-9]{2}:[0-9]{2}(:[0-9]{2})?( ?[AP]M)?( ?(Z|[+-][0-9]{2}:?[0-9]{2}))?)?$', 0) AS clock FROM s),
d AS (SELECT *, left(t, length(t) - length(clock)) AS date FROM w),
f AS (SELECT *,
  CASE WHEN regexp_full_match(date, '20[0-9]{2}-[0-9]{2}-[0-9]{2}') THEN [left(date, 4), substr(date, 6, 2), right(date, 2)]
       WHEN regexp_full_match(date, '20[0-9]{6}') THEN [left(date, 4), substr(date, 5, 2), right(date, 2)]
       WHEN regexp_full_match(date, '[0-9]{2}[.][0-9]{2}[.]20[0-9]{2}') THEN [right(date, 4), substr(date, 4, 2), left(date, 2)]
       WHEN regexp_full_match(date, '[0-9]{2} (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) 20[0-9]{2}')
         THEN [right(date, 4), lpad(((strpos('JanFebMarAprMayJunJulAugSepOctNovDec', substr(date, 4, 3)) + 2) // 3)::VARCHAR, 2, '0'), left(date, 2)] END AS one,
  regexp_full_match(date, '[0-9]{2}/[0-9]{2}/20[0-9]{2}') AS slashed,
  regexp_extract(clock, '([AP])M', 1) AS half, nullif(regexp_extract(clock, '(Z|[+-][0-9]{2}:?[0-9]{2})$', 1), '') AS shift,
  try_cast(nullif(substr(clock, 2, 2), '') AS INT) AS h, try_cast(nullif(substr(clock, 5, 2), '') AS INT) AS m,
  coalesce(try_cast(nullif(regexp_extract(clock, '^[T ][0-9]{2}:[0-9]{2}:([0-9]{2})', 1), '') AS INT), 0) AS sec FROM d),
p AS (SELECT *, CASE WHEN regexp_full_match(t, '[0-9]{10}') THEN t::BIGINT * 1000000 WHEN regexp_full_match(t, '[0-9]{13}') THEN t::BIGINT * 1000 END AS epoch,
  CASE WHEN slashed THEN try_cast(right(date, 4) || '-' || substr(date, 4, 2) || '-' || left(date, 2) AS DATE) ELSE try_cast(array_to_string(one, '-') AS DATE) END AS df,
  CASE WHEN slashed THEN try_cast(right(date, 4) || '-' || left(date, 2) || '-' || substr(date, 4, 2) AS DATE) ELSE try_cast(array_to_string(one, '-') AS DATE) END AS mf,
  CASE WHEN clock = '' THEN 0 WHEN m > 59 OR sec > 59 THEN NULL
       WHEN half = '' AND h <= 23 THEN h * 3600 + m * 60 + sec
       WHEN half <> '' AND h BETWEEN 1 AND 12 THEN (h % 12 + CASE half WHEN 'P' THEN 12 ELSE 0 END) * 3600 + m * 60 + sec END AS secs,
  CASE WHEN shift = 'Z' THEN 0 WHEN substr(shift, 2, 2)::INT <= 14 AND right(shift, 2)::INT <= 59
       THEN (substr(shift, 2, 2)::INT * 3600 + right(shift, 2)::INT * 60) * CASE left(shift, 1) WHEN '-' THEN -1 ELSE 1 END END AS ahead FROM f),
g AS (SELECT *, epoch IS NOT NULL OR coalesce(secs IS NOT NULL AND (df IS NOT NULL OR mf IS NOT NULL)
  AND CASE WHEN shift IS NULL THEN zone IN (SELECT name FROM pg_timezone_names()) ELSE ahead IS NOT NULL END, false) AS good FROM p),
v AS (SELECT source, count(*) FILTER (good AND slashed AND df IS NOT NULL AND mf IS NULL) AS dv, count(*) FILTER (good AND slashed AND mf IS NOT NULL AND df IS NULL) AS mv FROM g GROUP BY source),
r AS (SELECT g.*, CASE WHEN NOT good THEN 'bad' WHEN epoch IS NOT NULL THEN 'epoch' WHEN df IS NULL OR mf IS NULL OR df = mf THEN 'plain' WHEN dv > 10 * mv OR mv > 10 * dv THEN 'votes' ELSE 'default' END AS rule,
  CASE WHEN df IS NULL OR mf IS NULL THEN coalesce(df, mf) WHEN mv > 10 * dv THEN mf ELSE df END AS day FROM g LEFT JOIN v ON g.source IS NOT DISTINCT FROM v.source),
k AS (SELECT *, date_diff('second', TIMESTAMP '1970-01-01', day::TIMESTAMP) + secs AS wall, good AND epoch IS NULL AND shift IS NULL AS local FROM r),
o AS (SELECT *, CASE WHEN local THEN date_diff('second', to_timestamp(wall - 86400) AT TIME ZONE 'UTC', to_timestamp(wall - 86400) AT TIME ZONE zone) END AS b,
  CASE WHEN local THEN date_diff('second', to_timestamp(wall + 86400) AT TIME ZONE 'UTC', to_timestamp(wall + 86400) AT TIME ZONE zone) END AS a FROM k),
c AS (SELECT *, local AND date_diff('second', to_timestamp(wall - a) AT TIME ZONE 'UTC', to_timestamp(wall - a) AT TIME ZONE zone) = a AS fits_a,
  local AND date_diff('second', to_timestamp(wall - b) AT TIME ZONE 'UTC', to_timestamp(wall - b) AT TIME ZONE zone) = b AS fits_b FROM o)
SELECT stamp_id, CASE WHEN rule = 'bad' THEN NULL WHEN epoch IS NOT NULL THEN epoch WHEN NOT local THEN (wall - ahead) * 1000000
    WHEN fits_a OR NOT fits_b THEN (wall - a) * 1000000 ELSE (wall - b) * 1000000 END::BIGINT AS utc_us, rule,
  rule IN ('votes', 'default') OR coalesce(local AND a <> b AND fits_a = fits_b, false) AS ambiguous
FROM c
"""
