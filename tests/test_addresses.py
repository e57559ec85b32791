"""Addresses, networks and their match against Python's ipaddress."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from botlens.functions import addresses


def number(text):
    found = ipaddress.ip_address(text)
    return int(found) if found.version == 6 else (0xFFFF << 32) + int(found)


def sample(count=300):
    draw = random.Random(9)
    out = ["0.0.0.0", "255.255.255.255", "::", "::1", "1::", "2001:DB8::8:800:200c:417A", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33"]
    for _ in range(count):
        four = ipaddress.IPv4Address(draw.getrandbits(32))
        six = ipaddress.IPv6Address(draw.getrandbits(128) & draw.choice([(1 << 128) - 1, 0xFFFF << 96, 0xFFFF0000FFFF, (1 << 128) - (1 << 40)]))
        out += [str(four), str(six), six.exploded, str(six).upper()]
    return out


BAD = [None, "", "-", "1.2.3", "1.2.3.4.5", "256.1.1.1", "01.2.3.4", "1.2.3.4/8", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9",
       "12345::", "g::", "1:2:3:4:5:6:7::8", "::1.2.3.256", "1.2.3.4::", ":1:2:3:4:5:6:7", "unknown", "::1%eth0"]


def test_keys_are_the_numbers(spark):
    texts = sample()
    rows = spark.createDataFrame([(t,) for t in texts + BAD], "a string")
    found = {r.a: (r.k, r.f) for r in rows.select("a", addresses.address_key(F.col("a")).alias("k")).withColumn("f", addresses.address_family(F.col("k"))).collect()}
    assert {t: found[t][0] for t in texts} == {t: f"{number(t):032x}" for t in texts}
    assert {t: found[t] for t in BAD} == {t: (None, None) for t in BAD}
    assert found["0.0.0.0"][1] == 4 and found["::1"][1] == 6


def test_ends_of_networks(spark):
    draw = random.Random(10)
    rows = [(t, draw.randint(0, 128)) for t in sample(120)] + [("::1", 128), ("ffff::", 0), ("1.2.3.4", 127)]
    frame = spark.createDataFrame(rows, "a string, b int").withColumn("k", addresses.address_key(F.col("a")))
    for r in frame.select("a", "b", addresses.first_of(F.col("k"), F.col("b")).alias("first"), addresses.last_of(F.col("k"), F.col("b")).alias("last")).collect():
        low = number(r.a) >> (128 - r.b) << (128 - r.b)
        assert (r["first"], r["last"]) == (f"{low:032x}", f"{low + (1 << (128 - r.b)) - 1:032x}")


def test_the_narrowest_network_is_found(spark):
    draw = random.Random(11)
    texts = sample(150)
    networks = ["0.0.0.0/0", "::/0", "::1/128", "2001:db8::/32", "nonsense", "1.2.3.4/33", "1.2.3.4/", None, "::ffff:1.2.3.0/120"]
    for t in draw.sample(texts, 60):
        full = 32 if "." in t and ":" not in t else 128
        networks.append(f"{t}/{draw.randint(full // 4, full)}")
    networks += [texts[40], texts[41], networks[12]]

    def bits(n):
        address, _, length = n.partition("/")
        return number(address), int(length or 128) + (96 if length and ":" not in address else 0)

    good = sorted(n for n in set(networks) - {None, "nonsense", "1.2.3.4/33", "1.2.3.4/"})

    def want(t):
        fits = [(-bits(n)[1], n) for n in good if number(t) >> (128 - bits(n)[1]) == bits(n)[0] >> (128 - bits(n)[1])]
        return min(fits)[1] if fits else None

    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:20], *BAD])], "id int, client_ip string")
    listed = spark.createDataFrame([(n,) for n in networks], "network string")
    found = {r.id: r.network for r in addresses.matched_networks(rows, listed).collect()}
    assert len(found) == rows.count()
    for i, t in enumerate([*texts, *texts[:20]]):
        assert found[i] == want(t)
    assert all(found[i] is None for i in range(len(texts) + 20, len(found)))
    plan = addresses.matched_networks(rows, listed)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert addresses.matched_networks(rows, listed.where("false")).where("network is not null").count() == 0


@pytest.mark.parametrize("network, inside, outside", [
    ("10.0.0.0/8", "10.255.0.1", "11.0.0.0"), ("2001:db8::/33", "2001:db8:7fff::1", "2001:db8:8000::"), ("10.0.0.7", "10.0.0.7", "10.0.0.8"),
])
def test_one_network(spark, network, inside, outside):
    rows = spark.createDataFrame([(inside,), (outside,), ("x",), (None,)], "a string")
    assert [r.a for r in rows.where(addresses.in_network(F.col("a"), network)).collect()] == [inside]
