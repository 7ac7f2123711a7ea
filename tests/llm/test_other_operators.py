"""Archives, URL lists, search, language, quality and token shards."""

import hashlib
import random
import re
import time
import tracemalloc
from datetime import date

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feira.llm import byte_bpe, cotraining, language_id, training_order, url_lists, voronoi_knn, warc_chain
from feira.session import scratch_path
from tests.conftest import SMALL
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PAGES = "page_id long, url string, html string"


def page_rows():
    rng = random.Random(2)
    long = "".join(rng.choice("abc \r\n<>é") for _ in range(1500))
    nested = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.1\r\nContent-Length: 9999999\r\n\r\n"
    return [(1, "http://a.example/x", long), (2, None, long), (9, "http://b.example", long), (3, "u", long[:900]), (4, "u", long[:900]), (5, "u", None),
            (6, "u", ""), (7, "http://c\r\n.example", nested), (8, "u", nested + long), (10, "u", "\r\n\r\n" + long + "\r\n"), (10, "u", "\r\n\r\n" + long + "\r\n"),
            (None, "u", long), (-4, "u", "WARC/1.1\r\n" * 300)]


def wanted_records(rows):
    out, groups = [], {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    for page, _, html in rows:
        data = (html or "").encode()
        holder = max((p for p in groups[html or ""] if p is not None), default=None)
        again = len(data) >= 1000 and holder is not None and page != holder
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", holder if again else None))
    return sorted(out, key=cases.sort_key)


@pytest.mark.parametrize("range_bytes", [8_000_000, 700])
def test_archives_round_trip(spark, range_bytes):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(2)
    path = scratch_path(spark, "warc")
    warc_chain.write_archives(warc_chain.plan_records(pages), path)
    back = warc_chain.read_archives(spark, path, range_bytes).collect()
    bodies = sorted((r.header["warc-record-id"], bytes(r.payload)) for r in back if r.header["warc-type"] == "response")
    want = sorted((f"<urn:page:{w[0]}>", (h or "").encode()) for w in wanted_records(rows) if w[3] == "response"
                  for h in {h or "" for p, _, h in rows if p == w[0] and hashlib.sha1((h or "").encode()).hexdigest() == w[2]})
    assert bodies == want and len(back) == len(rows)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r.header["warc-date"]) for r in back)


def test_pages_to_records(spark):
    rows = page_rows()
    found = warc_chain.archive_and_read(spark.createDataFrame(rows, PAGES).withColumn("key", F.lit(1)))
    assert sorted((tuple(r) for r in found.collect()), key=cases.sort_key) == wanted_records(rows)
    assert warc_chain.archive_and_read(spark.createDataFrame([], PAGES)).collect() == []


def test_false_candidates_are_not_reached():
    record = b"WARC/1.1\r\nContent-Length: 60\r\n\r\n" + b"x" * 10 + b"WARC/1.1\r\nContent-Length: 3\r\n\r\n" + b"y" * 19 + b"\r\n\r\n"
    found = dict(warc_chain.candidates_of_range(record * 3, 100, len(record) * 2))
    assert set(found) > {100, 100 + len(record)} and found[100] == 100 + 2 * len(record)


@pytest.mark.parametrize("range_bytes", [8_000_000, 700])
def test_long_urls_keep_their_pages(spark, range_bytes, monkeypatch):
    rows = [(k, f"http://a.example/{k}", f"page {k}") for k in range(20)]
    rows[5] = (5, "http://long.example/" + "u" * 100_000, "long")
    rows[6] = (6, "http://long.example/" + "WARC/1.1" * 3000 + "WARC/1.1", "WARC/1.1\r\nContent-Length: " + "9" * 30 + "\r\n\r\n")
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    path = scratch_path(spark, "warc")
    warc_chain.write_archives(warc_chain.plan_records(pages), path)
    back = warc_chain.read_archives(spark, path, range_bytes).collect()
    assert sorted((r.header["warc-target-uri"], bytes(r.payload).decode()) for r in back) == sorted(r[1:] for r in rows)
    assert sorted((tuple(r) for r in warc_chain.archive_and_read(pages).collect()), key=cases.sort_key) == wanted_records(rows)


def test_broken_archives_are_not_whole(spark, tmp_path):
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for name, data in (("gap", record * 3 + b"gap" + record * 3), ("short", record * 3 + record[:-6])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.txt").write_bytes(data)
        for range_bytes in (8_000_000, 50):
            assert len(warc_chain.read_archives(spark, str(tmp_path / name), range_bytes).collect()) >= 3
            with pytest.raises(Exception, match="no whole record at byte"):
                warc_chain.read_archives(spark, str(tmp_path / name), range_bytes, whole_files=True).collect()


def test_candidates_take_one_pass():
    data = b"xWARC/1.1\r\n" * 200_000 + b"Content-Length: 3\r\n\r\nabc\r\n\r\n"
    found = warc_chain.candidates_of_range(data, 0, len(data))
    assert len(found) == 200_000 and {out for _, out in found} == {len(data)}


def listed(spark, rows):
    return spark.createDataFrame(rows, "list string, domain string, action string, day date")


def test_lists_are_judged_as_of_the_day(spark):
    entries = listed(spark, [
        ("block", "bad.example", "add", date(2020, 1, 10)), ("block", "bad.example", "add", date(2020, 1, 12)),
        ("block", "bad.example", "remove", date(2020, 3, 1)), ("block", "bad.example", "add", date(2020, 3, 5)), ("block", "bad.example", "remove", date(2020, 3, 5)),
        ("allow", "good.bad.example", "add", date(2020, 2, 1)), ("block", "EXAMPLE", "add", date(2022, 1, 1)), ("allow", "tie.example", "add", date(2020, 1, 1)),
        ("block", "tie.example", "add", date(2020, 1, 1)), (None, "x", "add", date(2020, 1, 1)), ("block", None, "add", None), ("block", "x", "odd", date(2020, 1, 1))])
    rows = [(1, "https://u@www.bad.example:80/p", date(2020, 1, 9)), (2, "http://www.BAD.example/", date(2020, 1, 10)), (3, "http://bad.example", date(2020, 2, 29)),
            (4, "http://bad.example", date(2020, 3, 1)), (5, "http://bad.example", date(2020, 6, 1)), (6, "http://a.good.bad.example.", date(2020, 2, 2)),
            (7, "http://notbad.example/", date(2020, 2, 2)), (8, "http://notbad.example/", date(2023, 2, 2)), (9, None, date(2020, 2, 2)), (10, "no url", None),
            (11, "http://tie.example", date(2020, 2, 2)), (11, "http://tie.example", date(2020, 2, 2))]
    captures = spark.createDataFrame([(*r, "extra") for r in rows], "page_id int, url string, day date, verdict string")
    found = sorted((r.page_id, r.verdict, r.n_active, r.decided_by, r.listed_since) for r in url_lists.judge(captures, entries).collect())
    assert found == [
        (1, "none", 0, None, None), (2, "block", 1, "bad.example", date(2020, 1, 10)), (3, "block", 1, "bad.example", date(2020, 1, 10)), (4, "none", 0, None, None),
        (5, "none", 0, None, None), (6, "allow", 2, "good.bad.example", date(2020, 2, 1)), (7, "none", 0, None, None), (8, "block", 1, "example", date(2022, 1, 1)),
        (9, "none", 0, None, None), (10, "none", 0, None, None), (11, "allow", 2, "tie.example", date(2020, 1, 1)), (11, "allow", 2, "tie.example", date(2020, 1, 1))]


def test_lists_without_rows(spark):
    captures = spark.createDataFrame([(1, "http://a.b", date(2020, 1, 1))], "page_id int, url string, day date")
    assert url_lists.judge(captures, listed(spark, [])).first().verdict == "none"
    assert url_lists.judge(captures.limit(0), listed(spark, [("block", "b", "add", date(2020, 1, 1))])).collect() == []


def test_lists_run_without_python(spark):
    from feira.llm.queries import queries

    text = queries()["op2_url_lists"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas"))


def brute_nearest(rows, every, top=5):
    vectors = [(k, [int(np.floor(256 * float(x))) for x in v]) for k, v in rows
               if k is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in dict(reversed(vectors)).items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), k) for k, y in vectors if k != q and len(y) == len(x))[:top]
            out += [(q, n + 1, k, -s) for n, (s, k) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("clustered", [True, False])
def test_nearest_is_exact(spark, clustered, monkeypatch):
    monkeypatch.setattr(voronoi_knn, "VECTORS_AT_ONCE", 50)
    monkeypatch.setattr(voronoi_knn, "QUERIES_AT_ONCE", 7)
    monkeypatch.setattr(voronoi_knn, "PIVOTS", 12)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 6)) * (3 if clustered else 0)
    rows = [(k, [float(np.float32(x)) for x in centres[k % 8] + rng.normal(size=6) * 0.1]) for k in range(400)]
    rows += [(k, rows[0][1]) for k in range(400, 560)]  # many equal vectors
    rows += [(600, None), (605, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (610, [float("nan")] * 6), (615, [float("inf")] * 6), (620, []), (None, rows[1][1]),
             (625, [1.0, 2.0]), (626, [0.5, -1.0]), (630, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).repartition(3)
    assert sorted(tuple(r) for r in voronoi_knn.nearest(frame, every=5).collect()) == brute_nearest(rows, 5)
    assert voronoi_knn.nearest(frame.limit(0), every=5).collect() == []


def test_repeated_queries_do_not_fill_their_cell(spark, monkeypatch):
    monkeypatch.setattr(voronoi_knn, "PIVOTS", 4)
    rows = [(5, [1000.0, 0.0])] * 7 + [(k, [0.0, 500.0 + k]) for k in (1, 2, 3, 4, 6, 7)] + [(k, [-800.0, -k / 8]) for k in (11, 12, 13)]
    rows += [(15, [0.0, -900.0])] * 8 + [(16, [0.0, -900.0])] * 2
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for pivots in (4, 64):
        monkeypatch.setattr(voronoi_knn, "PIVOTS", pivots)
        assert sorted(tuple(r) for r in voronoi_knn.nearest(frame, every=5).collect()) == brute_nearest(rows, 5)


def test_far_cells_are_left_out():
    pivots = {2: np.array([[100.0, 0.0], [0.0, 100.0], [-100.0, 0.0]])}
    pairs = voronoi_knn.reachable([(2, 0, 50, 5.0), (2, 1, 50, 5.0), (2, 2, 50, 5.0)], [(2, 0, 5.0)], pivots, 5)
    assert pairs == [(2, 0, 0)]


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    found = language_id.languages(docs.withColumn("score", F.lit(1)).withColumn("lang_pred", F.lit("x"))).join(docs, "doc_id")
    held = found.where("held_out").select("lang", "lang_pred").collect()
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_languages_of_odd_texts(spark):
    words = {"en": "the thing with the other thing", "de": "der schöne ich und nicht", "fr": "le français avec être", "xx": "qqq zzz qzq"}
    rows = [(k, " ".join([words[v]] * 5), v) for k, v in enumerate(list(words) * 10)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 %% 34", "de"), (103, "the", None), (104, "x", None), (105, "qqq " * 40_000, None), (None, words["fr"], None),
           (105, "qqq " * 40_000, None), (106, "日本", None)]
    schema = "doc_id long, text string, lang string"
    model = language_id.learn(spark.createDataFrame(rows + odd, schema))
    found = language_id.identify(spark.createDataFrame(rows + odd, schema), model).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(r.lang_pred == r.lang and r.score > 0.4 for r in found if r.doc_id is not None and r.doc_id < 100)
    by = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[105][0] == "xx" and by[None][0] == "fr" and by[106][0] in words and all(0 <= s <= 1 for _, s in by.values())
    nothing = language_id.learn(spark.createDataFrame([], schema))
    assert {r.lang_pred for r in language_id.identify(spark.createDataFrame(rows[:3], schema), nothing).collect()} == {"und"}
    single = language_id.learn(spark.createDataFrame(rows[:1], schema))
    assert {r.lang_pred for r in language_id.identify(spark.createDataFrame(rows[:3], schema), single).collect()} == {"en"}


@pytest.mark.parametrize("hot", [None, 3])
def test_languages_of_rows_that_share_an_id(spark, hot, monkeypatch):
    words = {"de": "der schöne ich und nicht", "en": "the thing with the other thing", "fr": "le français avec être"}
    rows = [(k, f"{words[v]} {k} {words[v]}", v) for k, v in enumerate(["de", "en", "fr"] * 100)]
    rows += [(hot, f"{words['de']} {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]} {words['de']}", "de") for k in range(100)] + [(hot, "und", "de")] * 50
    learned = []
    monkeypatch.setattr(language_id, "fit", lambda vectors, languages: learned.extend(languages))
    language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), max_rows=60)
    assert {v: learned.count(v) for v in words} == {"de": 20, "en": 20, "fr": 20}


def test_quality_of_rows_set_aside(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    aside = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    found = cotraining.score_documents(docs, labels.where(~aside), rounds=1, picks=20)
    assert found.count() == docs.count() and found.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    rows = found.join(labels.where(aside), "doc_id").collect()
    assert rows and sum(r.good == (r.quality == 1) for r in rows) >= 0.85 * len(rows)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(cases.documents(), cases.SCHEMA).withColumn("a", F.lit(1)).withColumn("score", F.lit("x"))
    one_class = spark.createDataFrame([(0, 1), (1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    found = cotraining.score_documents(docs, one_class).collect()
    assert len(found) == docs.count() and {r.score for r in found} == {0.5}
    assert cotraining.score_documents(docs.limit(0), one_class).collect() == []


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 1000, 4097])
def test_places_are_a_permutation(total):
    found = training_order.places(np.arange(total), total, "k")
    assert sorted(found.tolist()) == list(range(total))
    assert total < 64 or found.tolist() != list(range(total)) != training_order.places(np.arange(total), total, "other").tolist()


def test_shards_hold_every_token_once(spark):
    rows = cases.documents()
    docs = spark.createDataFrame(rows, cases.SCHEMA).withColumn("place", F.lit(1)).repartition(3)
    manifest = training_order.materialise(docs, RANKS, public_tokenizers.PATTERN, "k", sequence=16, shard_records=50)
    back = training_order.read_shards(manifest, 0, 16, 50).collect()
    assert [r.place for r in sorted(back, key=lambda r: r.place)] == list(range(len(back)))
    by = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    want = sorted((r[0] is None, r[0] or 0, k // 16, ids[k:k + 16]) for r in rows for ids in [by.encode_ordinary(r[1] or "")] for k in range(0, len(ids), 16))
    assert sorted((r.doc is None, r.doc or 0, r.part, np.frombuffer(r.tokens, "<u2").tolist()) for r in back) == want
    resumed = training_order.read_shards(manifest, 120, 16, 50).collect()
    assert sorted(map(tuple, resumed)) == sorted(tuple(r) for r in back if r.place >= 120) if not any(r.doc is None for r in back) else len(resumed) == len(back) - 120
    none = training_order.materialise(docs.limit(0), RANKS, public_tokenizers.PATTERN, "k")
    assert none.collect() == [] and training_order.read_shards(none).collect() == []


def shuffle_bytes(spark):
    """Bytes of the shuffle files that the session has on disk now."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = 0
    while files.hasNext():
        file = files.next()
        found += file.length() if file.getName().startswith("shuffle_") else 0
    return found


def test_shards_need_little_disk_beside_them(spark, tmp_path):
    """The table of sequences is compressed, passes give the shards of a single pass, and their shuffles don't stay."""
    texts = [(k, " ".join(f"word{(k * 31 + j * j) % 977}" for j in range(300))) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = training_order.sequences(docs, RANKS, public_tokenizers.PATTERN, sequence=64)
    for file in (f.removeprefix("file://") for f in rows.inputFiles()):
        assert pq.ParquetFile(file).metadata.row_group(0).column(2).compression == "ZSTD"
    placed, total = training_order.numbered(rows, "k")
    before = shuffle_bytes(spark)
    shards = [training_order.write_shards(placed, f"file://{tmp_path}/{k}", 64, 500, k) for k in (1, 3)]
    assert spark.conf.get(training_order.REMOVES_SHUFFLES) == "false"
    until = time.monotonic() + 20  # Spark removes them in the background
    while shuffle_bytes(spark) > before and time.monotonic() < until:
        time.sleep(0.1)
    assert shuffle_bytes(spark) <= before
    one, three = ({r.shard: (r.records, open(r.path.removeprefix("file://"), "rb").read()) for r in s.collect()} for s in shards)
    assert one == three and list(sorted(one)) == list(range(-(-total // 500))) and sum(n for n, _ in one.values()) == total


def test_learning_holds_the_features_once():
    """The driver's memory for learning is the matrix of features, not several copies of it."""
    vectors = [v for v in np.random.default_rng(1).random((600, 1 << language_id.BITS), np.float32)]
    whole = sum(v.nbytes for v in vectors)
    tracemalloc.start()
    language_id.fit(vectors, ["en", "fr"] * 300)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * whole
