"""Stable identifiers: fingerprints, fixed-slot sessions, row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(ip: Column, agent: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("-", ip, agent)), 1, 16)


def slot_session(fp: Column, ts: Column, seconds: int = 1800) -> Column:
    """Session id from the fingerprint and the fixed time slot."""
    slot = F.floor(F.unix_timestamp(ts) / seconds)
    return F.substring(F.md5(F.concat_ws("-", fp, slot.cast("string"))), 1, 16)


def user_kind(sdk: Column) -> tuple[Column, Column]:
    """User type and tier by SDK."""
    official = sdk.startswith("WST")
    kind = F.when(official, F.lit("government_user")).when(sdk != "", F.lit("registered")).otherwise(F.lit("guest"))
    tier = F.when(official, F.lit("verified")).when(sdk != "", F.lit("standard")).otherwise(F.lit("free"))
    return kind, tier


def row_id(ts_text: Column, line: Column) -> Column:
    """First 15 hex digits of md5(time + line) as a long."""
    return F.conv(F.substring(F.md5(F.concat(ts_text, line)), 1, 15), 16, 10).cast("long")


def trace_id(ts_text: Column, ip: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("-", ts_text, ip)), 1, 16)
