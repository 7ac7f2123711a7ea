"""Spelling variants beside a brute-force version over whole texts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feira.llm import spelling_variants as S
from tests.conftest import SMALL
from tests.llm import cases


def brute_words(rows, every=97):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute_variants(n):
    """All pairs of lengths at most one apart, by comparing letters."""
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[k + 1:] == b[k + 1:] if len(a) == len(b) else len(b) - len(a) == 1 and a[k:] == b[k + 1:])

    # Words one edit apart have the first or the last half of the shorter one in common.
    heads = {}
    for w in n:
        for half in {("head", w[:2]), ("tail", w[-2:])}:
            heads.setdefault(half, []).append(w)
    found = {w: {x for half in (("head", w[:2]), ("tail", w[-2:])) for x in heads[half] if near(w, x)} for w in n}
    form = {}
    for w in n:
        best = min(found[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=cases.sort_key)


def collected(frame):
    return sorted((tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=cases.sort_key)


def test_query_agrees_with_brute_force(spark):
    from feira.llm.queries import queries

    rows = [tuple(r) for r in spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text").collect()]
    got = collected(queries()["op13_spelling_variants"](spark, SMALL))
    assert got == brute_variants(brute_words(rows)) and sum(r[1] is not None for r in got) > 20


def odd_documents():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(150)]
    texts = [" ".join(rng.choice(stems) for _ in range(300)) for _ in range(12)]
    long = "x" * 3000
    texts += [None, "", "12 ++ 34", "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ÷×" * 3, f"{long} {long} {long}", f"{long}y {long}y {long}y z{long[1:]} z{long[1:]} z{long[1:]}",
              "Aaaaa aaaaaa aaaaaaa " * 4, "one日two threé fours fours fours wÖrds wörds WÖRDS " * 3, "aaaaa" * 40_000, "river " * 50 + "rivers " * 20 + "riverss " * 6]
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, texts[1], "x", 2), (None, texts[1], "x", 2)]


@pytest.mark.parametrize("small", [True, False])
def test_odd_texts(spark, small, monkeypatch):
    if small:  # several filters per length, several passes, several flushes
        monkeypatch.setattr(S, "WORDS_PER_FILTER", 5)
        monkeypatch.setattr(S, "FILTER_BYTES", 1500)
        monkeypatch.setattr(S, "COUNTED_AT_ONCE", 20)
    rows = odd_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    words = S.count_words(docs, damaged_every=97)
    want = brute_words([r[:2] for r in rows])
    assert {r.word: r.n for r in words.collect()} == want and any("é" in w for w in want) and "x" * 3000 in want
    got = collected(S.variants(words))
    assert got == brute_variants(want)
    assert any(r[2] not in (r[0], r[1]) for r in got), "no chain of forms"
    assert S.variants(S.count_words(docs.limit(0))).collect() == []


def test_long_chains_have_one_root(spark):
    words = ["b" * k + "a" * (40 - k) for k in range(40)]
    frame = spark.createDataFrame([(w, 2**k) for k, w in enumerate(words)], "word string, n long")
    got = S.variants(frame).collect()
    assert {r.root for r in got} == {words[-1]} and sorted(r.n_near for r in got) == [1, 1] + [2] * 38


def test_filters_know_their_words():
    rng = np.random.default_rng(3)
    spots = rng.integers(0, 2**63, 40_000).astype(np.uint64)
    bits = S.make_filter(spots[:20_000])
    assert len(S.passing(bits, spots[:20_000])) == 20_000 and len(S.passing(bits, spots[20_000:])) < 200
