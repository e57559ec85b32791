"""Client addresses as numbers: both families in one order, networks as ranges.

An address becomes 32 hexadecimal digits, its 128-bit number at full width, so text order is the order of the
numbers; an IPv4 address stands in the mapped range (``::ffff:0:0/96``). What is no address is NULL. All of it is
built-in column functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAPPED = "00000000000000000000ffff"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_SIDE = "([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?"
_V6 = f"^{_SIDE}(::{_SIDE})?$"


def _v4_digits(text: Column) -> Column:
    return F.lower(F.array_join(F.transform(F.split(text, r"\."), lambda o: F.lpad(F.hex(o.try_cast("int")), 2, "0")), ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """A value computed once and used in several places; as a plain expression it would be repeated in each."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _groups(text: Column) -> Column:
    """Groups of one side of ``::``, none for an empty side."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _v6_digits(text: Column) -> Column:
    def of_sides(sides: Column) -> Column:
        right = F.when(F.size(sides) == 2, _groups(F.get(sides, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        return _let(F.struct(_groups(sides[0]).alias("l"), right.alias("r"), F.size(sides).alias("n")), of_groups)

    def of_groups(g: Column) -> Column:
        missing = F.lit(8) - F.size(g["l"]) - F.size(g["r"])
        # ``::`` stands for one group at least.
        fits = ((g["n"] == 2) & (missing >= 1)) | ((g["n"] == 1) & (missing == 0))
        whole = F.concat(g["l"], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), g["r"])
        return F.when(fits, F.array_join(F.transform(whole, lambda x: F.lpad(x, 4, "0")), ""))

    return F.when(text.rlike(_V6) & text.contains(":"), _let(F.split(text, "::", -1), of_sides))


def address_key(address: Column) -> Column:
    """The 32 digits of an IPv4 or IPv6 address, NULL for any other text."""
    def dotted_tail(parts: Column) -> Column:
        digits = _v4_digits(parts[1])
        return F.when(parts[1].rlike(_V4), F.concat(parts[0], F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4)))

    def of_text(text: Column) -> Column:
        # A dotted tail of an IPv6 address is two groups.
        tail = r"^(.*:)([0-9.]+)$"
        split = F.array(F.regexp_extract(text, tail, 1), F.regexp_extract(text, tail, 2))
        plain = F.when(text.contains(":") & text.contains("."), _let(split, dotted_tail)).otherwise(text)
        return F.when(text.rlike(_V4), F.concat(F.lit(MAPPED), _v4_digits(text))).otherwise(_let(plain, _v6_digits))

    return F.when(address.isNotNull(), _let(F.lower(F.trim(address)), of_text))


def address_family(key: Column) -> Column:
    """4 or 6, NULL without an address."""
    return F.when(key.startswith(MAPPED), 4).when(key.isNotNull(), 6)


def _nibble(key: Column, bits: Column) -> Column:
    """The digit that the network's end falls into, as a number."""
    return F.conv(F.substring(key, F.floor(bits / 4).cast("int") + 1, F.lit(1)), 16, 10).cast("int")


def _digit(number: Column) -> Column:
    return F.lower(F.hex(number))


def first_of(key: Column, bits: Column) -> Column:
    """The first address of the network of ``bits`` (0 to 128) that the address lies in."""
    bits = bits.cast("int")
    apart = F.call_function("shiftright", _nibble(key, bits), 4 - bits % 4)
    split = _digit(F.call_function("shiftleft", apart, 4 - bits % 4))
    whole = F.substring(key, F.lit(1), F.floor(bits / 4).cast("int"))
    return F.when(bits >= 128, key).otherwise(F.rpad(F.concat(whole, split), 32, "0"))


def last_of(key: Column, bits: Column) -> Column:
    """The last address of that network."""
    bits = bits.cast("int")
    split = _digit(_nibble(key, bits).bitwiseOR(F.call_function("shiftright", F.lit(15), bits % 4)))
    whole = F.substring(key, F.lit(1), F.floor(bits / 4).cast("int"))
    return F.when(bits >= 128, key).otherwise(F.rpad(F.concat(whole, split), 32, "f"))


def network_bits(network: Column) -> Column:
    """Length in 128-bit terms of a network like ``10.0.0.0/8`` or ``2001:db8::/32``; a lone address is a whole one.
    NULL for what is no network."""
    parts = F.split(network, "/", -1)
    given = F.when(F.size(parts) == 1, F.lit(128)).when(
        (F.size(parts) == 2) & F.get(parts, F.lit(1)).rlike("^[0-9]{1,3}$"),
        F.get(parts, F.lit(1)).cast("int") + F.when(parts[0].contains(":"), 0).otherwise(96),
    )
    return F.when(address_key(parts[0]).isNotNull() & (given <= 128), given)


def in_network(address: Column, network: str) -> Column:
    """Whether an address lies in a network, by comparing its number with the network's ends."""
    bits, key = network_bits(F.lit(network)), address_key(F.split(F.lit(network), "/")[0])
    return address_key(address).between(first_of(key, bits), last_of(key, bits))


def matched_networks(rows: DataFrame, networks: DataFrame, address: str = "client_ip", network: str = "network") -> DataFrame:
    """Rows with ``network``, the narrowest of the listed networks that holds their address, or NULL.

    Each different address is cut to each length that the list has (129 at most) and met by equality, so neither a
    long list nor many rows are compared one with another. What is no network is left out; a network that
    is listed twice counts once, written as it comes first in text order.
    """
    bits = network_bits(F.col(network))
    listed = (
        networks.select(F.col(network).alias("_network"), bits.alias("_bits"), address_key(F.split(network, "/")[0]).alias("_key"))
        .where("_bits is not null").select(first_of(F.col("_key"), F.col("_bits")).alias("_first"), "_bits", "_network")
        .groupBy("_first", "_bits").agg(F.min("_network").alias("_network"))
    )
    lengths = listed.agg(F.sort_array(F.collect_set("_bits"))).scalar()
    addresses = rows.select(F.col(address).alias("_address")).where("_address is not null").distinct()
    cut = addresses.withColumn("_key", address_key(F.col("_address"))).where("_key is not null").withColumn("_bits", F.explode(lengths))
    met = cut.select("_address", "_bits", first_of(F.col("_key"), F.col("_bits")).alias("_first")).join(listed, ["_first", "_bits"])
    narrowest = met.groupBy("_address").agg(F.max(F.struct("_bits", "_network")).alias("_m")).select("_address", F.col("_m._network").alias(network))
    return rows.join(narrowest, F.col(address) == F.col("_address"), "left").drop("_address")
