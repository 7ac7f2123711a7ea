"""Money, rounding, identifiers and protection of sensitive fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from feira.functions.dates import mean_hundredths

MONEY = "decimal(14,2)"


def money(value: Column) -> Column:
    """Two decimals, half away from zero."""
    return value.cast(MONEY)


def mean_money(amount: Column, n: Column) -> Column:
    """``amount`` over ``n`` to two decimals, half away from zero, rounded only once."""
    cents = (amount * 100).cast("decimal(28,0)")
    return mean_hundredths(cents, n.cast("decimal(28,0)")).cast("decimal(12,2)")


def round_half_even(value: Column, scale: int = 2) -> Column:
    return F.bround(value, scale)


def discounted(price: Column, percentage: Column, amount: Column) -> Column:
    """Price after a percentage or a fixed discount, never below zero."""
    by_share = price * (F.lit(100).cast("decimal(5,2)") - percentage) / F.lit(100).cast("decimal(5,2)")
    reduced = F.coalesce(by_share.cast(MONEY), (price - amount).cast(MONEY), price.cast(MONEY))
    return F.greatest(reduced, F.lit(0).cast(MONEY))


def distinct_from(a: Column, b: Column) -> Column:
    """True where the values differ, counting NULL as a value."""
    return ~a.eqNullSafe(b)


def derived_uuid(*parts: Column) -> Column:
    """Repeatable identifier in UUID form from a natural key; a NULL part keeps its place."""
    marked = [F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts]
    digest = F.sha2(F.concat_ws("\u0001", *marked), 256)
    return F.concat_ws("-", *(F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def fingerprint(value: Column) -> Column:
    return F.sha2(value, 256)


def encrypt(value: Column, key: Column) -> Column:
    return F.base64(F.aes_encrypt(value, key))


def decrypt(value: Column, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(value), key).cast("string")


def comparable(value: Column, kind: T.DataType) -> Column:
    """A form of any value that can be hashed and is equal for equal values: maps sorted, variants as text."""
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    if isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(
            comparable(e["key"], kind.keyType).alias("key"), comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(pairs)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: comparable(e, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.struct(*[comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return value
