"""The registered queries beside their SQL, and the pipeline beside a brute-force version."""

import hashlib
import os
import random
import subprocess
import sys

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feira.llm import byte_bpe, language_id
from feira.llm.queries import oracle_sql, queries
from tests.conftest import SMALL
from tests.llm import cases
from tools.compare import compare, duck


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    assert compare(duck(SMALL), name, queries()[name](spark, SMALL), oracle_sql()[name]) == ""


def test_every_operator_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries()) == list(range(1, 14))


def test_rest_works_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("feira.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
names = set(e.queries()) | set(e.oracle_sql())
assert names and not any(n.startswith("op") or n == "pipeline" for n in names)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def brute_pipeline(rows, items, language):
    """Tokens digest of every document that is left, by plain loops."""
    rows = [r for r in rows if language(r[1]) != "und"]
    kept = {d for d, n, c in cases.similar_components([r[:2] for r in rows]) if c == d}
    rows = [r for r in rows if r[0] in kept]
    texts = [r[1].encode() for r in rows]
    cut = []
    for t, spans in zip(texts, cases.repeated(texts, corpus_pipeline.REPEATED)):
        whole = []
        for a, b in spans:
            while a < b and t[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(t) and t[b] & 0xC0 == 0x80:
                b -= 1
            whole.append((a, b))
        cut.append(cases.without(t, whole).decode())
    windows = set()
    for _, text in items:
        w = cases.bench_words(text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    by = byte_bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = []
    for r, text in zip(rows, cut):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        import re

        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
        words, hit = [low[a:b] for a, b in places], set()
        for size in {len(x) for x in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
        gone = set()
        for k in hit:
            gone |= set(range(*places[k]))
            if k + 1 in hit:
                gone |= set(range(places[k][1], places[k + 1][0]))
        text = "".join(c for k, c in enumerate(text) if k not in gone)
        ids = by.encode_ordinary(text)
        out.append((r[0], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_pipeline_agrees_with_brute_force(spark, tmp_path):
    rows = [r for r in cases.documents() if r[0] is not None][:-1]  # ids are unique here
    items = [(1, " ".join(rows[2][1].split()[10:40])), (2, rows[4][1]), (3, None)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")

    def language(text):
        return "und" if not text or not any(map(str.isalpha, text)) else "xx"

    found = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())
    assert found == brute_pipeline(rows, items, language)


def test_pipeline_with_repeated_and_null_ids(spark, tmp_path):
    rows = cases.documents()
    unnamed = "é" + cases.sentence(random.Random(9), 150)
    rows = [*rows, *rows[1:3], (2, unnamed[:400], None, None, None), *[(None, unnamed, "en", None, None)] * 2, (None, unnamed + " more", None, None, None)]
    items = [(1, " ".join(rows[2][1].split()[10:40]))]
    folder = str(tmp_path)
    spark.createDataFrame(rows, cases.SCHEMA).repartition(3).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")

    def language(text):
        return "und" if not text or not any(map(str.isalpha, text)) else "xx"

    kept = cases.one_of_each([r[:2] for r in rows if language(r[1]) != "und"])
    numbered = brute_pipeline([(k, text) for k, (_, text) in enumerate(kept)], items, language)
    assert len(numbered) == len(kept)
    found = sorted((tuple(r) for r in corpus_pipeline.run(spark, folder).collect()), key=cases.sort_key)
    assert found == sorted(((kept[r[0]][0], *r[1:]) for r in numbered), key=cases.sort_key)


def test_texts_stay_without_labels(spark):
    rows = [(1, "some text", None), (2, "12 %%", None), (3, None, "en"), (4, "mehr Text", None), (None, "é", None), (6, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, SMALL).collect()} == {1, 4, None}


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    spoiled = docs.union(docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string"), "lang", "source", "n_chars"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, spoiled, SMALL)
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in docs.schema], name
    assert language_id.UNKNOWN == "und"
