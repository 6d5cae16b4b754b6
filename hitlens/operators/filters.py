"""Row and group filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import present


def _bound(text: str | None, *, end: bool) -> datetime | None:
    if not text:
        return None
    try:
        return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
    except ValueError:
        day = datetime.strptime(text.split()[0], "%Y-%m-%d")
        return day + timedelta(days=1, microseconds=-1) if end else day


def _literal(moment: datetime) -> Column:
    return F.to_timestamp(F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")))


def between_times(df: DataFrame, ts: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Time range; a bare date as end means the end of that day; rows without a time stay."""
    lo, hi = _bound(start, end=False), _bound(end, end=True)
    test = F.lit(True)
    if lo:
        test = test & (F.col(ts) >= _literal(lo))
    if hi:
        test = test & (F.col(ts) <= _literal(hi))
    return df.filter(F.coalesce(test, F.lit(True)))


def one_of(df: DataFrame, column: str, values: Sequence[str] | DataFrame) -> DataFrame:
    """Include-list: a list is a predicate that reaches the scan, a table is a left-semi join."""
    if isinstance(values, DataFrame):
        return df.join(values, column, "left_semi").select(*df.columns)
    return df.filter(F.col(column).isin(*values))


def recent_or_all(df: DataFrame, ts: str, hours: int, now: datetime | str) -> DataFrame:
    """Rows of the last ``hours`` before ``now``; the whole table if that window is empty."""
    moment = now if isinstance(now, str) else now.strftime("%Y-%m-%d %H:%M:%S")
    since = F.to_timestamp(F.lit(moment)) - F.make_interval(hours=F.lit(hours))
    newest = df.agg(F.max(ts)).scalar()
    return df.filter((F.col(ts) >= since) | F.coalesce(newest < since, F.lit(True)))


def search(
    df: DataFrame,
    *,
    platform: str | None = None,
    entry_source: str | None = None,
    category: str | None = None,
    start: str | None = None,
    end: str | None = None,
    limit: int = 100,
    ts: str = "log_time",
    tie: str = "event_id",
) -> DataFrame:
    """Faceted listing, newest first."""
    out = between_times(df, ts, start, end)
    for column, value in (("platform", platform), ("entry_source", entry_source), ("api_category", category)):
        if value is not None:
            out = out.filter(F.col(column) == F.lit(value))
    return out.orderBy(F.desc(ts), F.desc(tie)).limit(limit)


def time_window(start: str | None, end: str | None, hours: int, now: datetime) -> tuple[datetime, datetime]:
    """Start and end from epoch seconds or ISO text; the last ``hours`` otherwise."""

    def parse(text: str | None) -> datetime | None:
        if not text:
            return None
        try:
            return datetime.fromtimestamp(float(text), timezone.utc).replace(tzinfo=None)
        except ValueError:
            try:
                return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)
            except ValueError:
                return None

    lo, hi = parse(start), parse(end)
    if lo and hi:
        return lo, hi
    return now - timedelta(hours=hours), now


def attack_paths(df: DataFrame, uri: str = "request_uri") -> DataFrame:
    return df.filter(F.col(uri).rlike(K.ATTACK_PATH))


def at_least(df: DataFrame, **bounds: float) -> DataFrame:
    """Post-aggregate threshold: every named column must reach its bound."""
    for column, bound in bounds.items():
        df = df.filter(F.col(column) >= F.lit(bound))
    return df


def known_clients(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows whose named headers are blank, ``-`` or ``unknown``."""
    for column in columns:
        df = df.filter(present(F.trim(F.col(column))).isNotNull() & (F.lower(F.col(column)) != "unknown"))
    return df
