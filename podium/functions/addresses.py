"""Internet addresses of both versions as two ordered longs, and blocks of them.

A dotted quad counts as its mapped IPv6 address, so one order holds all.  The longs order as signed
numbers do, by flipping the sign bit of the unsigned ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blocks that no public host has.  IPv4 by the special-purpose registry; of IPv6 only 2000::/3 is global
#: unicast, and of that documentation, tunnels and benchmarking are not public.
RESERVED_V4 = "0.0.0.0/8 10.0.0.0/8 100.64.0.0/10 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.0.0/24 192.0.2.0/24 192.168.0.0/16 198.18.0.0/15 198.51.100.0/24 203.0.113.0/24 224.0.0.0/4 240.0.0.0/4".split()
RESERVED_V6 = "::/3 2001::/32 2001:2::/32 2001:10::/32 2001:db8::/32 2002::/16 4000::/2 8000::/1".split()
SIGN = -(1 << 63)
MAPPED = 0xFFFF << 32


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def quad_number(address: Column) -> Column:
    """A dotted quad as a long; null if it is none."""

    def told(parts: Column) -> Column:
        whole = (F.size(parts) == 4) & F.forall(parts, lambda p: p.rlike("^[0-9]{1,3}$") & (p.try_cast("int") <= 255))
        return F.when(whole, F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n * 256 + p.try_cast("long")))

    return _bound(F.split(address, r"\."), told)


def _groups(text: Column) -> Column:
    """The eight 16-bit groups of an IPv6 address (array of longs); null if it is none."""

    def hexed(tail: Column) -> Column:
        """The text with its dotted tail as two groups; null if the tail is no quad."""
        head = F.left(text, F.length(text) - F.length(tail))
        return F.when(tail == "", text).otherwise(_bound(quad_number(tail), lambda n: F.concat(head, F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(65535))))))

    def read(plain: Column) -> Column:
        parts = F.transform(F.split(plain, "::", -1), lambda half: F.filter(F.split(half, ":"), lambda g: g != ""))
        shape = plain.rlike("^[0-9a-f:]+$") & ~plain.rlike("(^:[^:])|([^:]:$)|:::|[0-9a-f]{5}")

        def filled(halves: Column) -> Column:
            held = F.size(F.flatten(halves))
            zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - held, F.lit(0)))
            joined = F.when((F.size(halves) == 1) & (held == 8), F.get(halves, F.lit(0))).when((F.size(halves) == 2) & (held <= 7), F.concat(F.get(halves, F.lit(0)), zeros, F.get(halves, F.lit(1))))
            return F.transform(joined, lambda g: F.conv(g, 16, 10).cast("long"))

        return F.when(shape, _bound(parts, filled))

    return _bound(hexed(F.regexp_extract(text, r":(\d{1,3}(?:\.\d{1,3}){3})$", 1)), read)


def number(address: Column) -> Column:
    """struct(hi, lo) of an address, in an order that signed longs keep; null if it is none.  A zone (%eth0) and brackets go."""
    both = lambda hi, lo: F.struct(hi.bitwiseXOR(F.lit(SIGN)).alias("hi"), lo.bitwiseXOR(F.lit(SIGN)).alias("lo"))

    def long(groups: Column, a: int) -> Column:
        part = lambda k: F.get(groups, F.lit(a + k))
        return F.shiftleft(part(0), 48).bitwiseOR(F.shiftleft(part(1), 32)).bitwiseOR(F.shiftleft(part(2), 16)).bitwiseOR(part(3))

    def of(text: Column) -> Column:
        v4 = _bound(quad_number(text), lambda n: F.when(n.isNotNull(), both(F.lit(0).cast("long"), n.bitwiseOR(F.lit(MAPPED)))))
        v6 = _bound(_groups(text), lambda g: F.when(g.isNotNull(), both(long(g, 0), long(g, 4))))
        return F.when(F.contains(text, F.lit(":")), v6).otherwise(v4)

    return _bound(F.lower(F.regexp_replace(F.regexp_replace(F.trim(address), "%.*$", ""), r"^\[(.*)\]$", "$1")), of)


def bounds(block: Column) -> Column:
    """struct(low, high), both as ``number``: the first and the last address of a block such as 10.0.0.0/8 or 2001:db8::/32."""
    base, size = F.substring_index(block, "/", 1), F.substring_index(block, "/", -1).try_cast("int")
    ones = F.lit(-1).cast("long")
    # shifts count modulo 64, so none and all bits are told apart
    mask = lambda n: F.when(n <= 0, ones).when(n >= 64, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", ones, n))
    flip = lambda x: x.bitwiseXOR(F.lit(SIGN))

    def of(x: Column) -> Column:
        free = {"hi": mask(x["bits"]), "lo": mask(x["bits"] - 64)}
        low = F.struct(*[flip(flip(x["at"][c]).bitwiseAND(F.bitwise_not(m))).alias(c) for c, m in free.items()])
        high = F.struct(*[flip(flip(x["at"][c]).bitwiseOR(m)).alias(c) for c, m in free.items()])
        return F.when(x["at"].isNotNull() & x["bits"].between(0, 128), F.struct(low.alias("low"), high.alias("high")))

    return _bound(F.struct(number(base).alias("at"), F.when(F.contains(base, F.lit(":")), size).otherwise(size + 96).alias("bits")), of)


def _range(block: str) -> tuple[int, int]:
    """Where a fixed IPv4 block begins and ends."""
    base, bits = block.split("/")
    first = sum(int(x) << s for x, s in zip(base.split("."), (24, 16, 8, 0)))
    return first, first + (1 << (32 - int(bits))) - 1


def _prefix(block: str) -> tuple[int, int]:
    """The first 64 bits, as signed ordered longs, at which a fixed IPv6 block begins and ends."""
    base, bits = block.split("/")
    groups = [int(g, 16) for g in base.rstrip(":").split(":") if g]
    first = sum(g << (48 - 16 * k) for k, g in enumerate(groups))
    return first + SIGN, first + (1 << (64 - int(bits))) - 1 + SIGN


def is_reserved(address: Column) -> Column:
    """True for addresses that no public host has and for what is no address; mapped IPv4 addresses count as such."""
    inside = lambda value, ranges: F.coalesce(*[F.when(value.between(a, b), True) for a, b in ranges], F.lit(False))

    def of(at: Column) -> Column:
        low = at["lo"].bitwiseXOR(F.lit(SIGN))
        mapped = (at["hi"] == SIGN) & (F.shiftright(low, 32) == 0xFFFF)
        v4 = inside(low.bitwiseAND(0xFFFFFFFF), map(_range, RESERVED_V4))
        return F.when(at.isNull(), True).when(mapped, v4).otherwise(inside(at["hi"], map(_prefix, RESERVED_V6)))

    return _bound(number(address), of)
