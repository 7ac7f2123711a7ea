"""Validator documents compiled to rules over raw documents held as ``variant``.

A validator is a document of keywords, as document stores keep it with a collection: ``bsonType`` (a name or
a list of names), ``required``, ``properties``, ``items``, ``enum``, ``minimum`` and ``maximum``, nested at will.
Each keyword at each place becomes one rule, named after both, so a report says what is broken where. As a
column of expressions the rules run in one pass over any number of documents.

A property that is missing breaks only ``required``; JSON null is a value of type ``null``. Bounds concern
numbers only. In extended JSON a date is an object with ``$date``; numbers keep the kind they are written in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, functions as F

Check = Callable[[Column], Column]
INT = 2**31

# Kinds that Spark gives the values of a variant.
_KINDS = {
    "object": r"^OBJECT", "array": r"^ARRAY", "string": r"^STRING$", "bool": r"^BOOLEAN$", "null": r"^VOID$",
    "double": r"^(DOUBLE|FLOAT|DECIMAL.*)$", "decimal": r"^(DOUBLE|FLOAT|DECIMAL.*)$", "int": r"^BIGINT$", "long": r"^BIGINT$"}
_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _member(doc: Column, key: str) -> Column:
    """The value of a key; NULL where the document has none or is no object. Paths know no escapes, only two kinds of quotes."""
    quote = next((q for q in "\"'" if q not in key), None)
    if quote is None:
        raise ValueError(f"a key with both kinds of quotes can't be looked up: {key}")
    return F.try_variant_get(doc, f"$[{quote}{key}{quote}]", "variant")


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _is(value: Column, kind: str) -> Column:
    """Whether a value, which is there, has a type."""
    if kind == "date":
        written = F.try_variant_get(_member(value, "$date"), "$", "string")
        return _kind(value).rlike(_KINDS["object"]) & written.try_cast("timestamp").isNotNull()
    if kind not in _KINDS:
        raise ValueError(f"unknown type {kind!r}")
    found = _kind(value).rlike(_KINDS[kind])
    if kind == "int":
        found = found & F.try_variant_get(value, "$", "bigint").between(-INT, INT - 1)
    return found


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _typed(kinds: list[str]) -> Check:
    def check(value: Column) -> Column:
        found = F.lit(False)
        for kind in kinds:
            found = found | F.coalesce(_is(value, kind), F.lit(False))
        return found

    return check


def _one_of(values: list) -> Check:
    texts = [v for v in values if isinstance(v, str)]
    return lambda value: _kind(value).rlike(_KINDS["string"]) & F.try_variant_get(value, "$", "string").isin(texts)


def _bound(limit: float, least: bool) -> Check:
    def check(value: Column) -> Column:
        number = F.when(_kind(value).rlike(_NUMBER), F.try_variant_get(value, "$", "double"))
        return F.coalesce(number >= limit if least else number <= limit, F.lit(True))

    return check


def _holds(key: str) -> Check:
    return lambda value: ~_kind(value).rlike(_KINDS["object"]) | _member(value, key).isNotNull()


def _below(key: str, check: Check) -> Check:
    """The check of a member; a missing one passes."""
    def inner(value: Column) -> Column:
        member = _member(value, key)
        return member.isNull() | check(member)

    return inner


def _throughout(check: Check) -> Check:
    """The check of every element; what is no array passes."""
    return lambda value: F.coalesce(F.forall(_elements(value), lambda e: F.coalesce(check(e), F.lit(False))), F.lit(True))


def _checks(validator: dict, path: str) -> Iterator[tuple[str, Check]]:
    unknown = set(validator) - {"bsonType", "required", "properties", "items", "enum", "minimum", "maximum"}
    if unknown:
        raise ValueError(f"unknown keywords {sorted(unknown)} at {path or 'the top'}")
    if kinds := validator.get("bsonType"):
        yield f"type {path}", _typed([kinds] if isinstance(kinds, str) else kinds)
    if values := validator.get("enum"):
        yield f"enum {path}", _one_of(values)
    for keyword in ("minimum", "maximum"):
        if keyword in validator:
            yield f"{keyword} {path}", _bound(float(validator[keyword]), keyword == "minimum")
    for key in validator.get("required", []):
        yield f"required {path}.{key}".replace(" .", " "), _holds(key)
    for key, own in validator.get("properties", {}).items():
        for name, check in _checks(own, f"{path}.{key}".removeprefix(".")):
            yield name, _below(key, check)
    if "items" in validator:
        for name, check in _checks(validator["items"], f"{path}[]"):
            yield name, _throughout(check)


def rule_names(validator: dict) -> list[str]:
    """The names of a validator's rules."""
    return [name.strip() for name, _ in _checks(validator, "")]


def compile_validator(validator: dict, document: Column) -> dict[str, Column]:
    """Rules by name, such as ``required category.id`` or ``type events[].ts``, for a variant column.

    A rule is never NULL: a text that was no JSON at all, a NULL document, breaks the type at the top.
    """
    rules = {name.strip(): F.coalesce(check(document), F.lit(True)) for name, check in _checks(validator, "")}
    if "type" in rules:
        rules["type"] = document.isNotNull() & rules["type"]
    return rules
