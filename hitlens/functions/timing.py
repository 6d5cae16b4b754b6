"""Latency phases, speeds, efficiency and performance ladders (ms in, ratios in percent)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens.rules import ladder


def over(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Guarded division."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default))


def percent(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    return F.when(denominator > 0, numerator / denominator * 100).otherwise(F.lit(default))


def lifecycle(
    duration: Column,
    connect: Column,
    header: Column,
    response: Column,
    body: Column,
    sent: Column,
    *,
    unit_ms: bool = True,
    legacy_scale: bool = False,
    rounded: bool = True,
) -> dict[str, Column]:
    """Eighteen phase, ratio and speed columns.

    ``legacy_scale`` multiplies the three speeds by 100, as the percentage helper once did.
    Phases come out in seconds (6 digits), percentages with 2, sizes with 3 digits, unless
    ``rounded`` is off.
    """

    def fix(value: Column, digits: int) -> Column:
        return F.round(value, digits) if rounded else value

    unit = F.lit(1000.0 if unit_ms else 1.0)
    total, conn, head, resp = duration / unit, connect / unit, header / unit, response / unit
    zero = F.lit(0.0)
    process = F.greatest(zero, head - conn)
    backend_transfer = F.greatest(zero, resp - head)
    front_transfer = F.greatest(zero, total - resp)
    network = conn + front_transfer
    transfer = backend_transfer + front_transfer
    body_kb, sent_kb = body / F.lit(1024.0), sent / F.lit(1024.0)
    scale = 100.0 if legacy_scale else 1.0

    def speed(size: Column, seconds: Column) -> Column:
        return fix(over(size, seconds) * scale, 2)

    return {
        "backend_connect_phase": fix(conn, 6),
        "backend_process_phase": fix(process, 6),
        "backend_transfer_phase": fix(backend_transfer, 6),
        "front_transfer_phase": fix(front_transfer, 6),
        "backend_total_phase": fix(resp, 6),
        "network_phase": fix(network, 6),
        "processing_phase": fix(process, 6),
        "transfer_phase": fix(transfer, 6),
        "backend_efficiency": fix(percent(process, resp), 2),
        "network_overhead": fix(percent(network, total), 2),
        "transfer_ratio": fix(percent(transfer, total), 2),
        "body_kb": fix(body_kb, 3),
        "sent_kb": fix(sent_kb, 3),
        "response_speed": speed(body_kb, backend_transfer),
        "total_speed": speed(sent_kb, transfer),
        "front_speed": speed(sent_kb, front_transfer),
        "connection_cost": fix(percent(conn, resp), 2),
        "processing_index": fix(percent(process, conn, 1.0), 2),
    }


def estimated_phases(duration_ms: Column) -> dict[str, Column]:
    """Phases when the server logs no upstream times; each share truncates to whole ms."""

    def share(part: float) -> Column:
        return (duration_ms * F.lit(part)).cast("long")

    response, connect, header = share(0.7), share(0.05), share(0.15)
    return {
        "est_response_ms": response,
        "est_connect_ms": connect,
        "est_header_ms": header,
        "est_process_ms": header - connect,
        "est_transfer_ms": response - header,
        "est_front_ms": duration_ms - response,
        "est_network_ms": share(0.2),
    }


def estimated_phases_by_resource(
    duration_ms: Column, static: Column, app: Column, module: Column, cache: Column
) -> dict[str, Column]:
    """The estimate with ratios by kind of resource."""
    gateway = app.contains("gateway")

    def share(static_: float, auth: float, gate: float, hit: float, rest: float) -> Column:
        ratio = (
            F.when(static, F.lit(static_))
            .when(gateway & module.contains("auth"), F.lit(auth))
            .when(gateway, F.lit(gate))
            .when(cache == "HIT", F.lit(hit))
            .otherwise(F.lit(rest))
        )
        return (duration_ms * ratio).cast("long")

    return {
        "est_response_ms": share(0.1, 0.85, 0.75, 0.0, 0.7),
        "est_network_ms": share(0.2, 0.1, 0.15, 0.1, 0.2),
        "est_front_ms": share(0.7, 0.05, 0.1, 0.9, 0.1),
    }


def performance_level(ms: Column) -> Column:
    return ladder(ms, [(200, 1), (500, 2), (1000, 3), (3000, 4), (10000, 5)], 6)


def experience_level(ms: Column) -> Column:
    steps = [(200, "Excellent"), (500, "Good"), (1000, "Fair"), (3000, "Poor"), (10000, "Unacceptable")]
    return ladder(ms, steps, "Timeout")


def performance_rating(ms: Column) -> Column:
    return ladder(ms, [(200, "A"), (500, "B"), (1000, "C"), (3000, "D")], "F")


def performance_flags(ms: Column) -> dict[str, Column]:
    return {
        "perf_attention": ms > 500,
        "perf_warning": ms > 1000,
        "perf_slow": ms > 3000,
        "perf_very_slow": ms > 10000,
        "perf_timeout": ms > 30000,
    }


def performance_score(ms: Column) -> Column:
    return ladder(ms, [(0, 100.0), (100, 95.0), (500, 85.0), (1000, 70.0), (3000, 50.0), (10000, 30.0)], 10.0)


def apdex_class(ms: Column, satisfied: int = 500, tolerated: int = 2000) -> Column:
    return ladder(ms, [(satisfied, "Satisfied"), (tolerated, "Tolerating")], "Frustrated")


def transfer_metrics(ms: Column, body: Column, response: Column, network: Column, transfer: Column, connect: Column) -> dict[str, Column]:
    """Speed in KB/s and percentages of the whole request."""
    body_kb = body / F.lit(1024.0)
    return {
        "transfer_speed": F.when((ms > 0) & (body > 0), body_kb / (ms / F.lit(1000.0))).otherwise(F.lit(0.0)),
        "front_efficiency": F.when(ms > 0, (F.lit(1.0) - response / ms) * 100).otherwise(F.lit(100.0)),
        "network_share": percent(network, ms),
        "transfer_share": percent(transfer, ms),
        "connect_share": percent(connect, ms),
    }


def cache_status(ms: Column) -> Column:
    return F.when(ms < 10, F.lit("HIT")).when(ms > 3000, F.lit("MISS")).otherwise(F.lit("BYPASS"))


def shares(parts: dict[str, Column]) -> dict[str, Column]:
    """Each part as a percentage of the sum of all parts; all 0 if the sum is not positive."""
    total = sum(parts.values(), F.lit(0))
    return {name: percent(value, total) for name, value in parts.items()}


def lifecycle_disorder(connect: Column, header: Column, response: Column, total: Column) -> Column:
    """True where the times are not connect <= header <= response <= total."""
    return (connect > header) | (header > response) | (response > total)


def monotone(connect: Column, header: Column, response: Column, total: Column) -> tuple[Column, Column, Column]:
    """Header, response and total lifted so that the times never decrease."""
    h = F.greatest(header, connect)
    r = F.greatest(response, h)
    return h, r, F.greatest(total, r)


def coarse_experience(ms: Column) -> tuple[Column, Column]:
    """Experience and Apdex class with the coarse cut-offs 100 / 1000 / 3000 / 10000 ms."""
    steps = [(100, "Excellent"), (1000, "Good"), (3000, "Fair"), (10000, "Poor")]
    return ladder(ms, steps, "Unacceptable"), ladder(ms, [(1000, "Satisfied"), (3000, "Tolerating")], "Frustrated")
