"""Quality classification by co-training of two views of a document.

One classifier sees only the text (hashed trigrams and shares of kinds of characters, words and lines of the
whole text), the other only the metadata (source, language, recorded length). Both are logistic regressions
fitted on a bounded sample of labelled rows. In each of ``ROUNDS`` rounds each view scores all documents
without a label, and the ``PICKS`` it is surest of, per class, become training rows of the other view. In
the end each view is calibrated on labelled rows that neither was fitted on, the calibrated views are
combined there by a logistic regression of two weights, and every document is scored.

Bounds: ``MAX_LABELLED`` labelled rows, half of them per label, and 4 * PICKS pseudo-labels per round. Null texts
and metadata have empty features. Labels other than 0 and 1 are ignored. A document with several labels has the highest. Rows that repeat a document are scored each.
Labels without a document teach nothing. Without labels of both classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, tidy, utf8

ROUNDS = 3
PICKS = 300
MAX_LABELLED = 20_000
GRAM_BITS = 7
SOURCES, LANGUAGES, LENGTHS = 64, 16, 24

_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 white space, 4 other sign, 5 part of a longer character
_KIND[33:127] = 4
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[128:] = 5


def text_features(data: bytes) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)
    n = max(1, len(x))
    kinds = np.bincount(_KIND[x], minlength=6) / n
    upper = ((x >= 65) & (x <= 90)).sum() / n
    words = data.split()
    lines = [line for line in data.split(b"\n") if line]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    shares = [
        *kinds, upper, np.log1p(len(data)) / 12, np.log1p(len(words)) / 10, sizes.mean() / 10, sizes.std() / 10, min(sizes.max(), 100) / 100,
        len(set(words)) / max(1, len(words)), len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)) / 8,
        data.count(b".") / max(1, len(words)), data.count(b",") / max(1, len(words)), data.count(b"|") / n, data.count(b"http") / max(1, len(words))]
    grams = np.zeros(1 << GRAM_BITS)
    if len(x) > 2:
        small = np.where((x >= 65) & (x <= 90), x + 32, x).astype(np.uint32)
        code = ((small[:-2] << 16) | (small[1:-1] << 8) | small[2:]) * np.uint32(2654435761)
        grams = np.sqrt(np.bincount(code >> np.uint32(32 - GRAM_BITS), minlength=1 << GRAM_BITS) / (len(x) - 2))
    return np.concatenate((shares, grams)).astype(np.float32)


def meta_features(source: str | None, language: str | None, size: int | None) -> np.ndarray:
    out = np.zeros(SOURCES + LANGUAGES + LENGTHS, np.float32)
    if source is not None:
        out[xxhash.xxh3_64_intdigest(source) % SOURCES] = 1
    if language is not None:
        out[SOURCES + xxhash.xxh3_64_intdigest(language) % LANGUAGES] = 1
    if size is not None and size >= 0:
        out[SOURCES + LANGUAGES + min(LENGTHS - 1, int(size).bit_length())] = 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression, by Newton steps."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1).astype(np.float64)
    w, keep = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    keep[-1, -1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) @ w[:-1] + w[-1]


def chance(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def features(docs: DataFrame, key: str, text: str, source: str, language: str, size: str) -> DataFrame:
    """(key, a, b): both views of every document, as 32-bit floats, in a table of the shared folder."""
    schema = docs.select(F.col(key).alias("key")).schema.add("a", "binary").add("b", "binary")

    def each(batches):
        for batch in batches:
            a = [text_features(t).tobytes() for t in batch.column(1).to_pylist()]
            b = [meta_features(*row).tobytes() for row in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["key", "a", "b"])

    return written(docs.select(
        F.col(key).alias("key"), utf8(text).alias("t"), F.col(source).cast("string").alias("s"), F.col(language).cast("string").alias("l"),
        F.col(size).cast("long").alias("n")).mapInArrow(tidy(each), schema), "views")


def _stack(column) -> np.ndarray:
    rows = [np.frombuffer(x, np.float32) for x in column.to_pylist()]
    return np.stack(rows) if rows else np.zeros((0, 1), np.float32)


def _scored(views: DataFrame, score) -> DataFrame:
    """``views`` rows with the values that ``score(a, b)`` gives: one column per array."""
    def each(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(v) for v in score(_stack(batch.column(1)), _stack(batch.column(2))))],
                    names=["key", "text_score", "meta_score", "score"])

    schema = views.select("key").schema.add("text_score", "double").add("meta_score", "double").add("score", "double")
    return views.mapInArrow(tidy(each), schema)


def _sample(views: DataFrame, known: DataFrame, most: int) -> pa.Table:
    """(key, a, b, label, aside) of at most ``most`` labelled rows, half of them per label, by a hash of key and views.

    Keys are drawn first, then rows by their hashes, and both are broadcast; equal rows count once. So neither a
    key with very many rows nor a frequent label crowds out the other label.
    """
    order = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key")
    drawn = known.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most // 2).drop("nth")
    aside = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(5)) == 0
    rows = views.join(F.broadcast(drawn), "key").withColumns({"aside": aside, "hash": F.xxhash64("key", "a", "b")})
    limit = F.when(F.col("aside"), most // 10).otherwise(most // 2 - most // 10)
    chosen = rows.select("label", "aside", "hash").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("label", "aside").orderBy("hash"))).where(F.col("nth") <= limit).select("hash")
    found = rows.join(F.broadcast(chosen), "hash", "left_semi").select("key", "a", "b", "label", "aside")
    return found.dropDuplicates(["key", "a", "b"]).orderBy("key", "a", "b").toArrow()


def learn(views: DataFrame, labels: DataFrame, rounds: int = ROUNDS, picks: int = PICKS, max_labelled: int = MAX_LABELLED):
    """The function (a, b) -> (text chance, metadata chance, combined chance), or None without both classes."""
    known = labels.where("label IN (0, 1) AND key IS NOT NULL").groupBy("key").agg(F.max("label").alias("label"))
    rows = _sample(views, known, max_labelled)
    y, aside = rows.column("label").to_numpy().astype(np.float64), rows.column("aside").to_numpy().astype(bool)
    if len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
        return None
    a, b = _stack(rows.column("a")), _stack(rows.column("b"))
    train = {"a": [(a[~aside], y[~aside])], "b": [(b[~aside], y[~aside])]}
    named, taken = views.where("key IS NOT NULL"), []
    for turn in range(rounds + 1):
        w = {v: fit_logistic(np.concatenate([x for x, _ in own]), np.concatenate([z for _, z in own])) for v, own in train.items()}
        if turn == rounds:
            break
        wa, wb = w["a"], w["b"]
        # Only keys and scores meet the labels; the views themselves are never shuffled.
        scored = _scored(named, lambda x, z, wa=wa, wb=wb: (logit(x, wa), logit(z, wb), np.zeros(len(x)))).drop("score").join(known, "key", "left_anti")
        if taken:  # at most 4 * picks per round
            used = views.sparkSession.createDataFrame([(k,) for k in taken], views.select("key").schema)
            scored = scored.join(F.broadcast(used), "key", "left_anti")
        scored = written(scored, "scores")
        for view, other in (("text_score", "b"), ("meta_score", "a")):
            for label, order in ((1.0, F.desc(view)), (0.0, F.asc(view))):
                best = scored.where(F.col(view) > 0 if label else F.col(view) < 0).orderBy(order, F.xxhash64("key"), "key").limit(picks).select("key").distinct()
                found = views.join(F.broadcast(best), "key").select("key", F.col(other).alias("x")).orderBy("key", "x").limit(picks).toArrow()
                if found.num_rows:
                    train[other].append((_stack(found.column("x")), np.full(found.num_rows, label)))
                    taken += found.column("key").to_pylist()
        taken = list(dict.fromkeys(taken))
    la, lb = logit(a[aside], w["a"]), logit(b[aside], w["b"])
    ca, cb = fit_logistic(la[:, None], y[aside], 1e-3), fit_logistic(lb[:, None], y[aside], 1e-3)
    both = np.stack((logit(la[:, None], ca), logit(lb[:, None], cb)), axis=1)
    mixed = fit_logistic(both, y[aside], 1e-3)
    wa, wb = w["a"], w["b"]

    def score(x, z):
        va, vb = logit(logit(x, wa)[:, None], ca), logit(logit(z, wb)[:, None], cb)
        return chance(va), chance(vb), chance(logit(np.stack((va, vb), axis=1), mixed))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", language: str = "lang",
                    size: str = "n_chars", label: str = "quality", **options) -> DataFrame:
    """Per document: the calibrated chance of good quality by text, by metadata, and by both."""
    bounded_batches(docs.sparkSession)
    views = features(docs, key, text, source, language, size)
    score = learn(views, labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")), **options)
    if score is None:
        def score(x, z):
            return (np.full(len(x), 0.5),) * 3
    return _scored(views, score).select(
        F.col("key").alias(key), F.round("text_score", 6).alias("text_score"), F.round("meta_score", 6).alias("meta_score"),
        F.round("score", 6).alias("score"), (F.col("score") >= 0.5).alias("good"))
