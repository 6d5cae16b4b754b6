"""Client address classes and address-range lookup."""

from __future__ import annotations

import ipaddress
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import first_match, settled, starts_with_any

_IPV4 = r"^(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}$"


def ipv4_long(ip: Column) -> Column:
    """IPv4 text as a long, NULL for anything else."""
    parts = F.split(ip, r"\.")
    octet = [F.get(parts, F.lit(i)).try_cast("long") for i in range(4)]
    value = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    return F.when(ip.rlike(_IPV4), value)


def _bounds(cidr: str) -> tuple[int, int]:
    net = ipaddress.ip_network(cidr)
    return int(net.network_address), int(net.broadcast_address)


def in_networks(ip_long: Column, cidrs: Sequence[str]) -> Column:
    test = F.lit(False)
    for cidr in cidrs:
        lo, hi = _bounds(cidr)
        test = test | ip_long.between(lo, hi)
    return test


def ip_kind(ip: Column, number: Column | None = None) -> Column:
    """Private, multicast, public or invalid; private wins over loopback and reserved.

    ``number`` may pass the address as a long that is already a column.
    """
    n = ipv4_long(ip) if number is None else number
    v6 = ip.rlike("^[0-9a-fA-F:.]*:[0-9a-fA-F:.]*$")
    return (
        F.when(in_networks(n, K.PRIVATE_NETWORKS), F.lit("内网IP"))
        .when(in_networks(n, [K.MULTICAST_NETWORK]), F.lit("组播IP"))
        .when(n.isNotNull(), F.lit("公网IP"))
        .when(v6 & F.lower(ip).rlike(r"^(::1?$|f[cd]|fe[89ab])"), F.lit("内网IP"))
        .when(v6 & F.lower(ip).startswith("ff"), F.lit("组播IP"))
        .when(v6, F.lit("公网IP"))
        .otherwise(F.lit("无效IP"))
    )


def is_internal(ip: Column) -> Column:
    return F.coalesce(ip.rlike(K.INTERNAL_ADDRESS), F.lit(False))


def address_class(ip: Column) -> Column:
    """internal / loopback / external by the internal-address pattern."""
    return (
        F.when(ip.isNull() | (ip == ""), F.lit("unknown"))
        .when(is_internal(ip), F.lit("internal"))
        .when(ip == "localhost", F.lit("loopback"))
        .otherwise(F.lit("external"))
    )


def reputation(ip: Column) -> Column:
    return (
        F.when(is_internal(ip), F.lit("trusted"))
        .when(starts_with_any(ip, K.SUSPECT_PREFIXES), F.lit("suspicious"))
        .otherwise(F.lit("neutral"))
    )


def _outside(ip: Column, prefixes: Sequence[str]) -> Column:
    return F.coalesce(starts_with_any(ip, prefixes), F.lit(False)) & ~is_internal(ip)


def is_tor(ip: Column) -> Column:
    return _outside(ip, K.TOR_PREFIXES)


def is_vpn(ip: Column) -> Column:
    return _outside(ip, K.VPN_PREFIXES)


def is_datacenter(ip: Column) -> Column:
    return _outside(ip, K.DATACENTER_PREFIXES)


def is_proxy(ip: Column, peer: Column) -> Column:
    """Forwarded address differs from the peer, or a known proxy range."""
    return ~ip.eqNullSafe(peer) | F.coalesce(starts_with_any(ip, K.PROXY_PREFIXES), F.lit(False))


def carrier(ip: Column) -> Column:
    return F.when(is_internal(ip), F.lit("unknown")).otherwise(first_match(ip, K.CARRIER_PREFIXES, "unknown"))


def carrier_region(ip: Column) -> Column:
    """internal, China (where the carrier is known by prefix) or unknown."""
    return (
        F.when(ip.isNull() | (ip == "") | is_internal(ip), F.lit("internal"))
        .when(carrier(ip) != "unknown", F.lit("China"))
        .otherwise(F.lit("unknown"))
    )


def trusted_network(isp: Column) -> Column:
    """Addresses of the government network count as trusted."""
    return F.coalesce(isp == "Government Network", F.lit(False))


def network_carrier(ip: Column, networks=K.CARRIER_NETWORKS) -> tuple[Column, Column]:
    """Carrier and region of the first listed block that holds the address, NULL if none.

    For lists short enough to be code; longer tables go through :func:`locate`.
    """
    n = ipv4_long(ip)
    isp = region = None
    for cidr, carrier_, region_ in networks:
        hit = n.between(*_bounds(cidr))
        isp = F.when(hit, F.lit(carrier_)) if isp is None else isp.when(hit, F.lit(carrier_))
        region = F.when(hit, F.lit(region_)) if region is None else region.when(hit, F.lit(region_))
    return isp, region


def locate(df: DataFrame, ip: str, ranges: DataFrame, attributes: Sequence[str], *, block_bits: int = 16) -> DataFrame:
    """Left-join address ranges ``(position, lo, hi, *attributes)``; lowest position wins.

    The range test becomes an equi join on the leading ``32 - block_bits`` bits: each range is
    listed once per block it touches. Only distinct addresses take part in the range test, so a hot
    address costs one lookup; Spark sizes either side itself and broadcasts only what is small.
    """
    size = 1 << block_bits
    blocks = ranges.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("lo") / size), F.floor(F.col("hi") / size)))
    )
    addresses = df.select(F.col(ip).alias("_ip")).distinct().withColumn("_n", ipv4_long(F.col("_ip")))
    addresses = addresses.filter("_n is not null").withColumn("_block", F.floor(F.col("_n") / size))
    first = F.min_by(F.struct(*attributes), F.col("position")).alias("_hit")
    found = (
        addresses.join(blocks, "_block")
        .filter(F.col("_n").between(F.col("lo"), F.col("hi")))
        .groupBy("_ip")
        .agg(first)
    )
    picked = [F.col("_hit")[a].alias(a) for a in attributes]
    return df.join(found, df[ip] == found["_ip"], "left").select(*[df[c] for c in df.columns], *picked)


def with_address_key(df: DataFrame, ip: str, name: str) -> DataFrame:
    """Add ``family, hi, lo`` of an address, NULL if it is none; an IPv4 address written as IPv6 counts as IPv4.

    ``::`` and an IPv4 tail are written out first. Every step is a projection of its own: as one expression the
    text would be taken apart again for each use.
    """
    col, keep = F.col, df.columns
    none = F.array().cast("array<string>")

    def groups(index: int) -> Column:
        part = F.coalesce(F.get("_sides", F.lit(index)), F.lit(""))
        return F.when(part == "", none).otherwise(F.split(part, ":"))

    def key(family: int, high: Column, low: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), high.cast("long").alias("hi"), low.cast("long").alias("lo"))

    out = settled(df, {"_n": ipv4_long(col(ip)), "_text": F.lower(F.substring_index(col(ip), "%", 1))}, keep)
    out = settled(out, {"_tail": F.regexp_extract("_text", r":(\d+(?:\.\d+){3})$", 1)}, [*keep, "_n", "_text"])
    out = settled(out, {"_low": ipv4_long(col("_tail"))}, [*keep, "_n", "_text", "_tail"])
    head = F.substring(col("_text"), F.lit(1), F.char_length("_text") - F.char_length("_tail"))
    pair = F.lower(F.concat_ws(":", F.hex(F.floor(col("_low") / 65536)), F.hex(col("_low") % 65536)))
    text = F.when(col("_tail") == "", col("_text")).when(col("_low").isNotNull(), F.concat(head, pair))
    out = settled(out, {"_sides": F.split(text, "::")}, [*keep, "_n"])
    out = settled(out, {"_left": groups(0), "_right": groups(1)}, [*keep, "_n", "_sides"])
    missing = F.lit(8) - F.size("_left") - F.size("_right")
    filled = F.concat(col("_left"), F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), col("_right"))
    whole = F.when(F.size("_sides") == 1, col("_left")).when((F.size("_sides") == 2) & (missing >= 1), filled)
    out = settled(out, {"_groups": whole}, [*keep, "_n"])
    valid = (F.size("_groups") == 8) & F.forall("_groups", lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    digits = F.when(valid, F.array_join(F.transform("_groups", lambda g: F.lpad(g, 4, "0")), ""))
    out = settled(out, {"_digits": digits}, [*keep, "_n"])
    halves = {name_: F.conv(F.substring("_digits", at, 16), 16, -10).cast("long") for name_, at in (("_hi", 1), ("_lo", 17))}
    out = settled(out, halves, [*keep, "_n"])
    mapped = (col("_hi") == 0) & (F.shiftrightunsigned("_lo", 32) == 0xFFFF)
    found = (
        F.when(col("_n").isNotNull(), key(4, F.lit(0), col("_n")))
        .when(mapped, key(4, F.lit(0), col("_lo").bitwiseAND(F.lit(0xFFFFFFFF))))
        .when(col("_hi").isNotNull(), key(6, col("_hi"), col("_lo")))
    )
    return settled(out, {name: found}, keep)


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _prefix_mask(family: int, length: int) -> tuple[int, int]:
    """The two halves of a network's leading bits."""
    mask = ((1 << 32) - 1) ^ ((1 << (32 - length)) - 1) if family == 4 else ((1 << 128) - 1) ^ ((1 << (128 - length)) - 1)
    return _signed(mask >> 64), _signed(mask & ((1 << 64) - 1))


def locate_networks(
    df: DataFrame, ip: str, networks: DataFrame, attributes: Sequence[str], *, longest: bool = False
) -> DataFrame:
    """Left-join networks ``(position, cidr, *attributes)`` of IPv4 and IPv6; lowest position or longest prefix wins.

    An address is cut to each prefix length that the list has (162 at most) and meets the networks of that
    length by equality, so there is no range test, and wide networks need no blocks. Only distinct addresses
    take part. Networks that cannot be read match nothing.
    """
    width = F.when(F.col("_k.family") == 4, 32).otherwise(128)
    nets = with_address_key(networks.withColumn("_base", F.substring_index("cidr", "/", 1)), "_base", "_k")
    given = F.when(F.col("cidr").contains("/"), F.substring_index("cidr", "/", -1).try_cast("int")).otherwise(width)
    nets = nets.withColumn("_length", given).filter((F.col("_length") >= 0) & (F.col("_length") <= width))
    lengths = nets.select("_k.family", "_length").distinct().collect()  # at most 33 + 129
    fields = F.struct(*attributes)
    if not lengths:
        return df.select(*[df[c] for c in df.columns], *[F.lit(None).cast(networks.schema[a].dataType).alias(a) for a in attributes])

    def literal(family: int, length: int) -> Column:
        high, low = _prefix_mask(family, length)
        values = {"family": F.lit(family), "length": F.lit(length), "hi": F.lit(high).cast("long"), "lo": F.lit(low).cast("long")}
        return F.struct(*[v.alias(n) for n, v in values.items()])

    masks = F.array(*[literal(r.family, r["_length"]) for r in lengths])

    def cut(key: Column, mask: Column) -> Column:
        high, low = key["hi"].bitwiseAND(mask["hi"]), key["lo"].bitwiseAND(mask["lo"])
        return F.struct(mask["family"].alias("family"), mask["length"].alias("length"), high.alias("hi"), low.alias("lo"))

    mine = F.filter(masks, lambda m: (m["family"] == F.col("_k.family")) & (m["length"] == F.col("_length")))
    nets = nets.select("position", "_length", fields.alias("_hit"), cut(F.col("_k"), F.get(mine, F.lit(0))).alias("_net"))
    addresses = with_address_key(df.select(F.col(ip).alias("_ip")).distinct(), "_ip", "_k").filter("_k is not null")
    wanted = F.transform(F.filter(masks, lambda m: m["family"] == F.col("_k.family")), lambda m: cut(F.col("_k"), m))
    order = F.struct(-F.col("_length"), F.col("position")) if longest else F.col("position")
    tries = addresses.select("_ip", F.explode(wanted).alias("_cut"))
    found = tries.join(nets, F.col("_cut") == F.col("_net")).groupBy("_ip").agg(F.min_by("_hit", order).alias("_hit"))
    picked = [F.col("_hit")[a].alias(a) for a in attributes]
    return df.join(found, df[ip] == found["_ip"], "left").select(*[df[c] for c in df.columns], *picked)


def risk_label(bot: Column, connections: Column, error: Column, internal: Column) -> Column:
    """Bot 30, more than 100 requests per connection 40, error 20, internal -20."""
    score = (
        F.when(bot, 30).otherwise(0) + F.when(connections > 100, 40).otherwise(0) + F.when(error, 20).otherwise(0)
    )
    score = F.when(internal, F.greatest(F.lit(0), score - 20)).otherwise(score)
    return F.when(score >= 70, F.lit("High")).when(score >= 40, F.lit("Medium")).otherwise(F.lit("Low"))


def by_prefix(ip: Column, table: dict[str, Sequence[str]], default: str = "Other") -> Column:
    """Label of the first prefix list that holds the address."""
    out = None
    for label, prefixes in table.items():
        test = starts_with_any(ip, prefixes)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return F.when(ip.isNull() | (ip == ""), F.lit("Unknown")).otherwise(out.otherwise(F.lit(default)))
