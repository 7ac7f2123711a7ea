"""Co-training beside a version with plain loops, and with a labelled id that very many rows have."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import cotraining as C
from tests.conftest import SMALL
from tests.llm import cases

COLUMNS = ["doc_id", "text", "source", "lang", "n_chars"]


def brute(hashes, rows, labels, rounds, picks):
    """Chance of good quality by id, for distinct ids that are not null."""
    known = {}
    for doc, label in labels:
        if doc is not None and label in (0, 1):
            known[doc] = max(label, known.get(doc, 0))
    views = {r[0]: (C.text_features((r[1] or "").encode()), C.meta_features(*r[2:])) for r in rows}
    taught = sorted(d for d in known if d in views)
    aside, train = [d for d in taught if hashes[d][1] % 5 == 0], [d for d in taught if hashes[d][1] % 5]
    lessons = [[(views[d][v], float(known[d])) for d in train] for v in (0, 1)]
    taken = set()
    for turn in range(rounds + 1):
        w = [C.fit_logistic(np.stack([x for x, _ in own]), np.array([y for _, y in own])) for own in lessons]
        if turn == rounds:
            break
        pool = {d: [float(C.logit(views[d][v][None], w[v])[0]) for v in (0, 1)] for d in views if d not in known and d not in taken}
        for v in (0, 1):
            for label, sign in ((1.0, -1), (0.0, 1)):
                sure = [d for d in pool if (pool[d][v] > 0 if label else pool[d][v] < 0)]
                best = sorted(sure, key=lambda d: (sign * pool[d][v], hashes[d][0], d))[:picks]
                lessons[1 - v] += [(views[d][1 - v], label) for d in sorted(best)]
                taken |= set(best)
    logits = {d: [C.logit(views[d][v][None], w[v]) for v in (0, 1)] for d in views}
    truth = np.array([float(known[d]) for d in aside])
    fitted = [C.fit_logistic(np.stack([logits[d][v] for d in aside]), truth, 1e-3) for v in (0, 1)]
    both = {d: np.array([C.logit(logits[d][v][None], fitted[v])[0] for v in (0, 1)]) for d in views}
    mixed = C.fit_logistic(np.stack([both[d] for d in aside]), truth, 1e-3)
    return {d: float(C.chance(C.logit(both[d][None], mixed))[0]) for d in views}


@pytest.mark.parametrize("rounds", [0, 2])
def test_scores_agree_with_plain_loops(spark, rounds):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    hashes = {r[0]: r[1:] for r in docs.select("doc_id", F.xxhash64("doc_id"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5))).collect()}
    want = brute(hashes, rows, [tuple(r) for r in labels.select("doc_id", "quality").collect()], rounds, 7)
    found = {r.doc_id: r.score for r in C.score_documents(docs, labels, rounds=rounds, picks=7).collect()}
    assert found.keys() == want.keys() and max(abs(found[d] - want[d]) for d in want) < 1e-4 and len(set(found.values())) > 10


def test_a_hot_labelled_id_crowds_out_no_label(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    hot = labels.where("quality = 0").first().doc_id
    text = docs.where(F.col("doc_id") == hot).first().text
    copies = [(hot, f"{text} {k if k % 2 else ''}", "s", "en", len(text)) for k in range(160)]
    extra = spark.createDataFrame(copies, "doc_id long, text string, source string, lang string, n_chars long")
    found = C.score_documents(docs.select(*COLUMNS).union(extra), labels, rounds=1, picks=5, max_labelled=60)
    assert found.count() == docs.count() + 160 and found.select("score").distinct().count() > 10


def test_labels_that_teach_nothing(spark):
    docs = spark.createDataFrame(cases.documents(), cases.SCHEMA)
    labels = spark.createDataFrame([(k, 2 + k % 2) for k in range(20)], "doc_id long, quality int")
    assert {r.score for r in C.score_documents(docs, labels).collect()} == {0.5}
