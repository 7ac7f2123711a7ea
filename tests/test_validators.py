"""Validator documents compiled to rules: every keyword, at the top, in nested objects and in arrays."""

import pytest
from pyspark.sql import functions as F

from feira.functions import semistructured
from feira.operators.validators import compile_validator, rule_names
from feira.schemas import VALIDATORS

VALIDATOR = {
    "bsonType": "object", "required": ["a"],
    "properties": {
        "a": {"bsonType": ["int", "null"], "minimum": 2, "maximum": 4}, "d": {"bsonType": "date"}, "e": {"enum": ["x", "y"]},
        "n": {"bsonType": "double", "minimum": 0.5}, 'odd "key.': {"bsonType": "bool"},
        "o": {"bsonType": "object", "required": ["in"], "properties": {"in": {"bsonType": "string"}}},
        "l": {"bsonType": "array", "items": {"bsonType": "object", "required": ["k"], "properties": {"k": {"bsonType": "array", "items": {"bsonType": "long"}}}}}}}

DOCUMENTS = {
    '{"a":3}': [], '{"a":null}': [], "{}": ["required a"], '{"a":1}': ["minimum a"], '{"a":5}': ["maximum a"], '{"a":"3"}': ["type a"],
    '{"a":2.5}': ["type a"], '{"a":3e0}': ["type a"], '{"a":2147483648}': ["maximum a", "type a"], "[]": ["type"], "7": ["type"], "null": ["type"], "no json": ["type"],
    '{"a":3,"d":{"$date":"2024-01-01"},"e":"y","n":0.5,"odd \\"key.":true,"o":{"in":""},"l":[]}': [],
    '{"a":3,"d":"2024-01-01"}': ["type d"], '{"a":3,"d":{"$date":null}}': ["type d"], '{"a":3,"d":null}': ["type d"], '{"a":3,"e":1}': ["enum e"], '{"a":3,"e":null}': ["enum e"],
    '{"a":3,"n":0}': ["minimum n", "type n"], '{"a":3,"n":0.25}': ["minimum n"], '{"a":3,"n":null}': ["type n"], '{"a":3,"odd \\"key.":0}': ['type odd "key.'],
    '{"a":3,"o":{}}': ["required o.in"], '{"a":3,"o":[]}': ["type o"], '{"a":3,"o":{"in":null}}': ["type o.in"],
    '{"a":3,"l":[{"k":[1,2]},{"k":[]}]}': [], '{"a":3,"l":[{"k":[1]},{}]}': ["required l[].k"], '{"a":3,"l":[1]}': ["type l[]"], '{"a":3,"l":[null]}': ["type l[]"],
    '{"a":3,"l":{"k":1}}': ["type l"], '{"a":3,"l":[{"k":[1,null]}]}': ["type l[].k[]"], '{"a":3,"l":[{"k":["1"]},{"k":2}]}': ["type l[].k", "type l[].k[]"],
}


def test_each_keyword(spark):
    rows = spark.createDataFrame([(t,) for t in DOCUMENTS], "text string").withColumn("document", semistructured.parse(F.col("text")))
    rules = compile_validator(VALIDATOR, F.col("document"))
    assert list(rules) == rule_names(VALIDATOR)
    broken = F.array_sort(F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])))
    assert {r.text: r.broken for r in rows.select("text", broken.alias("broken")).collect()} == DOCUMENTS


def test_unknown_words_are_refused(spark):
    for validator in ({"bsonTyp": "int"}, {"properties": {"a": {"pattern": "x"}}}):
        with pytest.raises(ValueError, match="unknown keywords"):
            rule_names(validator)
    with pytest.raises(ValueError, match="unknown type"):
        compile_validator({"bsonType": "text"}, F.col("document"))


def test_every_collection_compiles(spark):
    for validator in VALIDATORS.values():
        names = rule_names(validator)
        assert len(names) == len(set(names)) == len(compile_validator(validator, F.col("document")))
