"""Scalar and aggregate expressions shared by the operators."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

def moment(at: datetime) -> Column:
    """A point in time as a timestamp; one without a zone is meant in UTC."""
    return F.lit(at if at.tzinfo else at.replace(tzinfo=timezone.utc))


def iso_timestamp(ts: Column) -> Column:
    """A timestamp as ISO-8601 text with microseconds and zone offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def billing_period(ts: Column) -> Column:
    """The month of a timestamp as ``yyyy-MM``."""
    return F.date_format(ts, "yyyy-MM")


# Multipliers and modulus of the integer mix below; 2^31 - 1 is prime and small
# enough that the product of two residues stays inside a 64-bit integer.
MIX_PRIME = 2147483647
MIX_ROW = 48271
MIX_HIGH = 69621
MIX_SALT = 1000003
MIX_SPREAD = 16807


def draw(row_id: Column, salt: int, bound: int) -> Column:
    """A reproducible pseudo-random integer in ``[0, bound)`` for a row id.

    Two squaring rounds modulo a prime, in plain 64-bit arithmetic: it stays in
    generated code, needs no random state, and gives the same value for a row
    wherever and however often its partition is computed.
    """
    row = row_id.cast("bigint")
    low = F.pmod(row, F.lit(MIX_PRIME))
    high = F.pmod(F.call_function("div", row, F.lit(MIX_PRIME)), F.lit(MIX_PRIME))
    start = (low * MIX_ROW + high * MIX_HIGH + salt * MIX_SALT) % MIX_PRIME
    mixed = (start * start + low) % MIX_PRIME
    spread = (mixed * MIX_SPREAD + start) % MIX_PRIME
    return ((spread * spread + mixed) % MIX_PRIME) % bound


def pick(row_id: Column, salt: int, choices: list[str]) -> Column:
    """A uniform choice from a short fixed list."""
    return F.get(F.array(*map(F.lit, choices)), draw(row_id, salt, len(choices)).cast("int"))


def lookup(key: Column, table: dict[str, float]) -> Column:
    """The value a short fixed table holds for ``key``; NULL when absent."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)
