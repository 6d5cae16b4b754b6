"""Address keys and network lookup against the standard library."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from hitlens.functions import network

ADDRESSES = [
    None, "", "-", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", ":1", "1:", ":::",
    "2001:DB8::ff00:42:8329", "fe80::1%eth0", "::ffff:10.1.2.3", "::ffff:999.1.2.3", "64:ff9b::192.0.2.33", "::1.2.3.4", "1.2.3.4", "256.1.1.1", "g::1", "12345::",
    "2001:db8:3::1", "2001:db8:3:8000::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "8000::", "10.1.2.3", "192.168.0.1",
]


def key(text):
    try:
        address = ipaddress.ip_address(text.split("%")[0])
    except (ValueError, AttributeError):
        return None
    if address.version == 6 and address.ipv4_mapped:
        address = address.ipv4_mapped
    number = int(address)
    return address.version, number


def test_address_keys(spark):
    rng = random.Random(3)
    drawn = [str(ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128) & rng.getrandbits(128))) for _ in range(200)]
    df = spark.createDataFrame([(a,) for a in ADDRESSES + drawn], "ip string")
    for r in network.with_address_key(df, "ip", "k").collect():
        want = key(r.ip)
        got = None if r.k is None else (r.k.family, (r.k.hi % 2**64) << 64 | r.k.lo % 2**64)
        assert got == want, r.ip


@pytest.mark.parametrize("longest", [False, True])
def test_networks_of_both_families(spark, longest):
    nets = ["10.0.0.0/8", "10.1.0.0/16", "::/0", "2001:db8::/32", "2001:db8:3::/48", "2001:db8:3::/49", "8000::/1", "1.2.3.4", "0.0.0.0/0", "::1/128", "no/9", "10.0.0.0/99", "fe80::/64"]
    table = spark.createDataFrame([(i, n, f"name {i}") for i, n in enumerate(nets)], "position int, cidr string, name string")
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ADDRESSES)], "id int, ip string")
    got = {r.id: r.name for r in network.locate_networks(df, "ip", table, ["name"], longest=longest).collect()}
    known = []
    for i, n in enumerate(nets):
        try:
            known.append((i, ipaddress.ip_network(n)))
        except ValueError:
            continue
    for i, a in enumerate(ADDRESSES):
        want = key(a)
        hits = [(-n.prefixlen if longest else 0, k) for k, n in known if want and n.version == want[0] and int(n.network_address) <= want[1] <= int(n.broadcast_address)]
        assert got[i] == (f"name {min(hits)[1]}" if hits else None), a
    none = network.locate_networks(df, "ip", table.limit(0), ["name"], longest=longest)
    assert none.filter(F.col("name").isNotNull()).count() == 0 and none.count() == len(ADDRESSES)
