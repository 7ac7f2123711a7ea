"""Similarity join, repeated strings, benchmark passages and tokens against brute force."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from feira.llm import byte_bpe, fm_decontam, group_matrix_join, run_length_dedup
from feira.llm.components import components
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def rows():
    return cases.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, cases.SCHEMA).repartition(3)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=cases.sort_key)


@pytest.mark.parametrize("block_sets", [256, 2])
def test_similar_components(docs, rows, block_sets):
    found = group_matrix_join.similar_components(docs, block_sets=block_sets)
    assert got(found.select("key", "n_shingles", "component_id")) == sorted(
        cases.similar_components([r[:2] for r in rows]), key=cases.sort_key)


def test_similar_components_of_random_edits(spark):
    import random

    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(80):
        text = list(words[:rng.choice([20, 40, 60])])
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(9)}"
        rows.append((k, " ".join(text)))
    found = group_matrix_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), block_sets=8)
    assert got(found.select("key", "n_shingles", "component_id")) == sorted(cases.similar_components(rows), key=cases.sort_key)


def test_one_of_each_keeps_the_columns(docs, rows):
    kept = group_matrix_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    smallest = {c for _, n, c in cases.similar_components([r[:2] for r in rows]) if n}
    assert {k for k in ids if k is not None} == smallest | {d for d, n, _ in cases.similar_components([r[:2] for r in rows]) if not n}


def test_one_of_each_keeps_one_row(spark, rows):
    unnamed = cases.sentence(random.Random(5), 100)
    rows = [*rows, *rows[:2], (0, rows[0][1], "fr", "s9", 1), (1, rows[2][1], None, None, None), (0, unnamed[:300], None, None, None), *[(None, unnamed, None, None, None)] * 3,
            (None, unnamed, "en", None, None), (None, "", None, None, None), (None, rows[1][1] + " more", None, None, None)]
    found = group_matrix_join.one_of_each(spark.createDataFrame(rows, cases.SCHEMA).repartition(3)).collect()
    assert all(tuple(r) in set(rows) for r in found)
    assert sorted(((r.doc_id, r.text) for r in found), key=cases.sort_key) == sorted(cases.one_of_each([r[:2] for r in rows]), key=cases.sort_key)


@pytest.mark.parametrize("crowd", [1000, 1])
def test_repeated_strings(docs, rows, crowd):
    texts = [(r[1] or "").encode() for r in rows]
    want = [(r[0], len(t), sum(b - a for a, b in s), len(s), hashlib.sha256(cases.without(t, s)).hexdigest())
            for r, t, s in zip(rows, texts, cases.repeated(texts, 400))]
    assert got(run_length_dedup.kept_digests(docs, crowd=crowd)) == sorted(want, key=cases.sort_key)


def test_repeated_strings_over_chunks(spark, monkeypatch):
    """Texts longer than a chunk lose the same strings."""
    import random

    rng = random.Random(1)
    shared = bytes(rng.choice(b"abcd ") for _ in range(700)).decode()
    texts = [bytes(rng.choice(b"abcd ") for _ in range(3000)).decode() + shared + "tail" * 40, "head" + shared + "z" * 900]
    monkeypatch.setattr(run_length_dedup, "_CHUNK", 1023)
    spans = run_length_dedup.anchors([t.encode() for t in texts])
    starts = sorted((int(k), s) for k, a, b in zip(*spans[:3]) for s in range(a, b + 1))
    assert starts == [(k, s) for k, t in enumerate(texts) for s in range(len(t) - 399)]


def test_matching_statistics_of_a_cell():
    import random

    rng = random.Random(5)
    core = bytes(rng.choice(b"ab") for _ in range(60))
    contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) + core[rng.randint(0, 9):] for _ in range(30)]
    contexts = list(dict.fromkeys(contexts))
    for length in (32, 40):
        found = run_length_dedup.repeats_in_cell(contexts, length)
        for k, c in enumerate(contexts):
            marked = {s for a, b in found[k] for s in range(a, b + 1)}
            want = {s for s in range(len(c) - length + 1) if any(c[s:s + length] in o for j, o in enumerate(contexts) if j != k) or c.count(c[s:s + length]) > 1}
            assert marked == want


def test_removed_repeats_leave_whole_characters(docs, rows):
    kept = {r.doc_id: r.text for r in run_length_dedup.remove_repeats(docs).where("doc_id IS NOT NULL").collect()}
    assert run_length_dedup.remove_repeats(docs).schema == docs.schema
    texts = [(r[1] or "").encode() for r in rows]
    for r, t, s in zip(rows, texts, cases.repeated(texts, 400)):
        if r[0] is not None and not s:
            assert kept[r[0]] == r[1]
    assert kept[next(r[0] for r in rows if r[1] is None)] is None


def items_of(rows):
    text = rows[2][1].split()
    return [(1, " ".join(text[10:40])), (2, " ".join(text[30:35])), (3, ""), (4, None), (None, " ".join(text[60:75])), (1, " ".join(text[10:40])),
            (10, rows[5][1].upper()), (11, "nowhere to be found in any of these texts at all")]


@pytest.mark.parametrize("block_bytes", [2_000_000, 200])
def test_contamination(spark, docs, rows, block_bytes):
    items = items_of(rows)
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = cases.contamination([r[:2] for r in rows], items)
    found = fm_decontam.find_phrases(docs.select("doc_id", "text"), frame, block_bytes=block_bytes).select("doc_id", "n_words", "n_hit", "items")
    assert got(found.select("doc_id", "n_words", "n_hit")) == sorted((w[:3] for w in want), key=cases.sort_key)
    if block_bytes > 1000:
        assert got(fm_decontam.contamination(docs, frame)) == sorted(want, key=cases.sort_key)


def test_phrases_are_cut_out(spark, docs, rows):
    frame = spark.createDataFrame(items_of(rows), "item_id long, text string")
    clean = fm_decontam.remove_phrases(docs, frame)
    assert clean.schema == docs.schema and clean.count() == len(rows)
    before = {r[0]: r[1] for r in rows}
    hit = {w[0] for w in cases.contamination([r[:2] for r in rows], items_of(rows)) if w[5]}
    for r in clean.where("doc_id IS NOT NULL").collect():
        assert (r.text != before[r.doc_id]) == (r.doc_id in hit)


def test_clashing_columns_survive(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", 5, "z")], "doc_id long, text string, n_hit int, items string")
    items = spark.createDataFrame([(1, "x y"), (2, "c d")], "item_id long, text string")
    assert [tuple(r) for r in fm_decontam.remove_phrases(docs, items).collect()] == [(1, "a b  e f g h i j k", 5, "z")]
    assert [tuple(r)[2:] for r in run_length_dedup.remove_repeats(docs).collect()] == [(5, "z")]
    assert byte_bpe.encode(docs.withColumnRenamed("items", "ids"), RANKS, public_tokenizers.PATTERN).columns == ["doc_id", "text", "n_hit", "ids"]


def test_tokens_and_bytes(docs, rows):
    by = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    want = []
    for r in rows:
        ids = by.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got(byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN)) == sorted(want, key=cases.sort_key)


@pytest.mark.parametrize("text", ["it's 12 o'clock  \n\n now\t tab   ", "  wide  blanks 　 here", "no_blank" * 50, " lead", "x  'll 've'd", "\U0001f600 été 1½"])
def test_parts_keep_the_matches(text):
    by = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for limit in (1, 2, 3, 7):
        assert byte_bpe.encode_text(text * 9, by, limit).tolist() == by.encode_ordinary(text * 9)
        assert "".join(byte_bpe.safe_parts(text * 9, limit)) == text * 9


def test_tokens_agree_with_another_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    by = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    assert isinstance(by, tiktoken.Encoding)
    for text in ("Plain words, 42 numbers.", "<|endoftext|> is text üß", "a\n\n b  c"):
        assert by.encode_ordinary(text) == other.encode(text, add_special_tokens=False).ids


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 9), (7, 7)] + [(k, k + 1) for k in range(100, 160)], "a long, b long")
    roots = {r.key: r.root for r in components(links).collect()}
    assert roots == {5: 1, 4: 1, 3: 1, 9: 7, 8: 7} | {k: 100 for k in range(101, 161)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], cases.SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    for frame in (group_matrix_join.join_components(none), run_length_dedup.kept_digests(none), fm_decontam.contamination(none, items),
                  byte_bpe.digests(none, RANKS, public_tokenizers.PATTERN)):
        assert frame.collect() == []
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in fm_decontam.contamination(some, items).collect()] == [(3, 0, False)]
    assert [tuple(r) for r in group_matrix_join.join_components(some).collect()] == [(1, 1, 1)]


@pytest.mark.parametrize("width", [1, 3, 100])
def test_shared_shingles_stream_through_batches(monkeypatch, width):
    import random

    import pyarrow as pa

    monkeypatch.setattr(group_matrix_join, "COUNTED", 3)
    rng = random.Random(width)
    rows = sorted((t, s) for t in range(40) for s in rng.choices(range(12), k=rng.choice([1, 1, 2, 4, 9])))
    batches = [pa.table({"token": [t for t, _ in part], "sig": [s for _, s in part]}).to_batches()[0]
               for part in (rows[k:k + width] for k in range(0, len(rows), width))]
    got = [tuple(r.values()) for b in group_matrix_join._shared_only(iter(batches)) for r in b.to_pylist()]
    sizes = {t: len({s for u, s in rows if u == t}) for t, _ in rows}
    assert got == [(t, s, min(sizes[t], 4)) for t, s in sorted(set(rows)) if sizes[t] > 1]


@pytest.mark.parametrize("shared", [None, 5])
def test_near_copies_that_share_an_id(spark, shared):
    """A third of the rows have one id, or none: they are told apart by their texts."""
    rng = random.Random(9)
    rows = []
    for k in range(40):
        words = cases.sentence(rng, 60).split()
        for j in range(3):
            words[rng.randrange(60)] = f"w{j}"
            rows.append((shared if j == 2 else 10 * k + j, " ".join(words)))
    rows += [rows[2]] * 30
    found = group_matrix_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), block_sets=8)
    assert got(found.select("key", "n_shingles", "component_id")) == sorted(cases.similar_components(rows), key=cases.sort_key)


def test_copies_with_edits_of_their_own_share_blocks(spark, monkeypatch):
    """Copies that are hardly similar to each other are asked in few blocks, not each pair in one of its own."""
    pick = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in pick.sample(range(len(words)), 7):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words + [f"p{k // 2}_{j}" for j in range(14)])))
    kept = {}
    write = group_matrix_join.written
    monkeypatch.setattr(group_matrix_join, "written", lambda frame, name: kept.setdefault(name, write(frame, name)))
    found = group_matrix_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found.select("key", "n_shingles", "component_id")) == sorted(cases.similar_components(rows), key=cases.sort_key)
    held, asked = kept["held"], kept["asked"]
    sets = held.select("sig").distinct().count()
    assert sets > 30
    assert held.select("block").distinct().count() <= sets // 5
    assert asked.count() <= sets * 8


def test_crowded_anchors_open_the_ends_of_passages_only(spark, monkeypatch):
    """Strings of a crowded anchor have a row of their own only where slices differ behind a shared core."""
    pick = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def noise(n):
        return "".join(pick.choice(letters) for _ in range(n))

    short, long = noise(300), noise(520)
    texts = [noise(450) + short + noise(450) for _ in range(25)] + [noise(450) + long + noise(450) for _ in range(25)]
    rows = list(enumerate(texts))
    kept = {}
    write = run_length_dedup.written
    monkeypatch.setattr(run_length_dedup, "written", lambda frame, name: kept.setdefault(name, write(frame, name)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = run_length_dedup.kept_digests(docs, crowd=3)
    spans = cases.repeated([t.encode() for t in texts], 400)
    want = [(k, len(t), sum(b - a for a, b in s), len(s)) for (k, t), s in zip(rows, spans)]
    assert [w[3] for w in want] == [0] * 25 + [1] * 25
    assert got(found.select("doc_id", "n_bytes", "n_removed", "n_spans")) == sorted(want, key=cases.sort_key)
    places = kept["contents"].where("crowded").selectExpr("sum(length(content) - 399)").first()[0]
    assert places > 10_000
    assert kept["strings"].count() + kept["slices"].count() < places / 4
