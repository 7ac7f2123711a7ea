"""Predicates inside JSON documents held as ``variant``."""

from __future__ import annotations

import operator
from functools import partial
from typing import Any

from pyspark.sql import Column, functions as F

COMPARE = {
    "=": operator.eq, "!=": operator.ne, "<": operator.lt,
    "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
NUMBER_KINDS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def parse(json: Column) -> Column:
    """Variant of a JSON text; NULL where the text is malformed."""
    return F.try_parse_json(json)


def _step(key: str) -> str:
    return '["{}"]'.format(key.replace("\\", "\\\\").replace('"', '\\"'))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def contains(doc: Column, wanted: Any) -> Column:
    """Whether the document holds everything in ``wanted``, at the same places.

    Objects may have more keys, arrays more elements in any order; numbers are equal by
    value and never equal to strings. The literal is walked while the plan is built.
    """
    if isinstance(wanted, dict):
        found = F.startswith(_kind(doc), F.lit("OBJECT"))
        for key, value in wanted.items():
            found = found & contains(F.try_variant_get(doc, "$" + _step(key), "variant"), value)
    elif isinstance(wanted, (list, tuple)):
        items = F.try_variant_get(doc, "$", "array<variant>")
        found = F.startswith(_kind(doc), F.lit("ARRAY"))
        for value in wanted:
            found = found & F.exists(items, partial(_contains_in, value))
    elif wanted is None:
        found = F.is_variant_null(doc)
    elif isinstance(wanted, bool):
        found = (_kind(doc) == "BOOLEAN") & (F.try_variant_get(doc, "$", "boolean") == F.lit(wanted))
    elif isinstance(wanted, (int, float)):
        found = _kind(doc).rlike(NUMBER_KINDS) & (
            F.try_variant_get(doc, "$", "double") == F.lit(float(wanted)))
    else:
        found = (_kind(doc) == "STRING") & (F.try_variant_get(doc, "$", "string") == F.lit(str(wanted)))
    return F.coalesce(found, F.lit(False))


def _contains_in(wanted: Any, item: Column) -> Column:
    return contains(item, wanted)


def path_compare(doc: Column, path: str, op: str, value: float) -> Column:
    """Whether the number at ``path``, or any number in an array there, satisfies the comparison."""
    def holds(item: Column) -> Column:
        number = F.when(_kind(item).rlike(NUMBER_KINDS), F.try_variant_get(item, "$", "double"))
        return F.coalesce(COMPARE[op](number, F.lit(float(value))), F.lit(False))

    single = F.try_variant_get(doc, path, "variant")
    many = F.try_variant_get(doc, path, "array<variant>")
    return holds(single) | F.coalesce(F.exists(many, holds), F.lit(False))


def text_at(doc: Column, path: str) -> Column:
    """Value at ``path`` as text; JSON null and missing give NULL."""
    return F.try_variant_get(doc, path, "string")


def int_at(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "int")
