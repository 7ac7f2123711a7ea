"""Relevance with corpus statistics, accents, and hierarchies of any depth."""

import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from feira.functions import text
from feira.operators import joins, search

ROWS = [(1, "Être ou ne pas être", None), (2, "etre", "le café"), (3, "être etre", "CAFÉ cafe"), (4, "êtres étreinte peut-être_2", ""), (5, None, None),
        (6, "rien ici", "rien là"), (7, "ÊTRE " * 50, "x"), (8, "3etre", "caféx"), (2, "etre", "le café")]


def brute(rows, weights, wanted):
    def words(value):
        plain = unicodedata.normalize("NFD", (value or "").lower())
        return re.findall(r"[^\W_]+", "".join(c for c in plain if not unicodedata.combining(c)))

    fields = [[words(v) for v in row[1:]] for row in rows]
    n, out = len(rows), []
    for row, own in zip(rows, fields):
        score, any_word = 0.0, False
        for i, weight in enumerate(weights):
            average = sum(len(f[i]) for f in fields) / n
            for t in sorted(set(words(wanted))):
                tf, df = own[i].count(t), sum(t in f[i] for f in fields)
                if tf:
                    any_word = True
                    score += weight * math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own[i]) / average))
        if any_word:
            out.append((row[0], score))
    return sorted(out, key=lambda r: (-r[1], r[0]))


def test_accents_do_not_matter(spark):
    df = spark.createDataFrame(ROWS, "k int, title string, body string")
    got = [tuple(r) for r in search.ranked_search(df, {"title": 3.0, "body": 1.0}, "Etre café être", "k").collect()]
    want = brute(ROWS, [3.0, 1.0], "Etre café être")
    assert [k for k, _ in got] == [k for k, _ in want]
    assert all(a == pytest.approx(b) for (_, a), (_, b) in zip(got, want)) and {1, 2, 3, 4, 7} == {k for k, _ in got}
    assert search.ranked_search(df, {"title": 1.0}, "absent", "k").collect() == [] == search.ranked_search(df, {"title": 1.0}, "...", "k").collect()
    assert search.ranked_search(df.limit(0), {"title": 1.0}, "etre", "k").collect() == []


def test_patterns_follow_unicode():
    assert text.folded_words("Ção, ÉTÉ-2!") == ["cao", "ete", "2"]
    assert "ã" in text.folded_pattern("a") and "ř" in text.folded_pattern("r") and "ø" not in text.folded_pattern("o")


def test_texts_are_read_once(spark):
    df = spark.createDataFrame(ROWS, "k int, title string, body string")
    plan = search.ranked_search(df, {"title": 1.0}, "etre", "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "title" not in plan and "regexp" not in plan


def test_deep_and_wide_hierarchies(spark):
    depth = 3000
    chain = spark.range(depth).select(F.col("id").alias("category_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_category_id"))
    wide = spark.range(10_000, 10_300).select(F.col("id").alias("category_id"), F.lit(depth - 1).cast("long").alias("parent_category_id"))
    ring = spark.range(50_000, 50_100).select(F.col("id").alias("category_id"), (F.pmod(F.col("id") + 1, F.lit(100)) + 50_000).alias("parent_category_id"))
    below = spark.range(1).select(F.lit(60_000).cast("long").alias("category_id"), F.lit(50_007).cast("long").alias("parent_category_id"))
    found = joins.category_paths(chain.union(wide).union(ring).union(below)).cache()
    assert found.count() == depth + 300 + 101 and found.where("NOT complete").count() == 101
    assert found.where("complete AND (root_id <> 0 OR size(path) <> depth + 1 OR element_at(path, -1) <> category_id OR path[0] <> 0)").isEmpty()
    assert found.agg(F.max("depth")).first()[0] == depth and found.where("NOT complete AND (path IS NOT NULL OR depth IS NOT NULL)").isEmpty()
