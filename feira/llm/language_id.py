"""Language identification in two steps: the family first, then one-versus-one linear SVMs within it.

Features are relative frequencies of hashed letter trigrams of the whole text, so a score is a mean of
weights over the trigrams and no feature vector is built when predicting. Training uses a bounded
sample of labelled rows: ``MAX_ROWS`` in all, the same number for each language, chosen by a hash of id
and text, so that rows may share one id or have none; equal rows are learned from once. Prediction reads every text to its end.

A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned.
Rows without a label or a text are not learned from. With one language, each text with letters has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, packed_bytes, release, tidy, utf8

UNKNOWN = "und"
BITS = 12
MAX_ROWS = 2000
CHUNK_BYTES = 1_000_000

# Families of languages by their two-letter codes. Any other language is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fo", "af", "lb", "fy", "yi"],
    "romance": ["fr", "es", "pt", "it", "ro", "ca", "gl", "oc", "la", "eo"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "baltic": ["lt", "lv"], "celtic": ["ga", "gd", "cy", "br"], "hellenic": ["el"], "albanian": ["sq"],
    "uralic": ["fi", "et", "hu"], "turkic": ["tr", "az", "kk", "ky", "uz", "tk", "tt"],
    "indo-aryan": ["hi", "bn", "ur", "mr", "gu", "pa", "ne", "si", "or", "as"],
    "iranian": ["fa", "ps", "ku", "tg"], "semitic": ["ar", "he", "am", "mt"],
    "dravidian": ["ta", "te", "kn", "ml"], "austronesian": ["id", "ms", "tl", "jv", "mg"],
    "japonic": ["ja"], "koreanic": ["ko"], "sinitic": ["zh"], "tai": ["th", "lo"], "austroasiatic": ["vi", "km"],
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

# Small letters, and one blank for everything else in ASCII; longer characters keep their bytes.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_GAP = b"   "


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, f"own:{language}")


def grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the trigram at each byte, and whether it counts (at most one blank)."""
    x = np.frombuffer(data.translate(_LETTERS), np.uint8)
    if len(x) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    wide = x.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    blank = x == 32
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS), ~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]))


def frequencies(text: bytes) -> np.ndarray:
    """Relative frequencies of the hashed trigrams of one text; blanks surround it."""
    code, counts = grams(b" " + text + b" ")
    found = np.bincount(code[counts], minlength=1 << BITS).astype(np.float32)
    return found / max(1.0, float(found.sum()))


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1000.0, rounds: int = 15) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; ``y`` is -1 or 1. Returns weights and bias."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)  # equal classes
    scale = cost / len(y)

    def values(v):  # the last weight is the bias
        return x @ v[:-1].astype(np.float32) + v[-1]

    def back(v):
        return np.append(x.T @ v.astype(np.float32), v.sum())

    w = np.zeros(x.shape[1] + 1)
    for _ in range(rounds):
        margin = 1 - y * values(w)
        weight = share * (margin > 0)
        gradient = w - 2 * scale * back(weight * y * margin)
        step, rest = np.zeros_like(w), -gradient
        direction, size = rest.copy(), rest @ rest
        for _ in range(30):  # conjugate gradients for the Newton step
            if size < 1e-8:
                break
            curved = direction + 2 * scale * back(weight * values(direction))
            along = size / (direction @ curved)
            step += along * direction
            rest -= along * curved
            size, before = rest @ rest, size
            direction = rest + size / before * direction
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _matrix(packed: pa.ChunkedArray) -> np.ndarray:
    """The compressed vectors as rows; unpacked one by one, so that the driver holds them once."""
    unpacker = zstandard.ZstdDecompressor()
    x = np.empty((len(packed), 1 << BITS), np.float32)
    for k, v in enumerate(packed):
        x[k] = np.frombuffer(unpacker.decompress(v.as_py()), np.float32)
    return x


def _spread(x: np.ndarray, columns: int = 256) -> np.ndarray:
    """Standard deviation of each column, some columns at a time: no copy of the whole matrix."""
    return np.concatenate([x[:, k:k + columns].std(axis=0) for k in range(0, x.shape[1], columns)])


def fit(vectors: list[np.ndarray] | np.ndarray, languages: list[str]) -> dict:
    """Hyperplanes: one per family against the rest, one per pair of languages of a family. A given matrix is scaled in place."""
    names = sorted(set(languages))
    families = sorted({family_of(x) for x in names})
    x = vectors if isinstance(vectors, np.ndarray) else np.stack(vectors) if vectors else np.zeros((0, 1 << BITS), np.float32)
    spread = 1 / (_spread(x) + 1e-4) if len(x) else np.ones(1 << BITS)
    x *= (spread / np.sqrt(1 << BITS)).astype(np.float32)
    label = np.array(languages)
    group = np.array([family_of(v) for v in languages])
    planes, kinds = [], []

    def add(rows, positive, kind):
        w, bias = fit_svm(x if rows is None else x[rows], np.where(positive, 1.0, -1.0))
        planes.append(np.append(w * spread / np.sqrt(1 << BITS), bias))
        kinds.append(kind)

    if len(families) > 1:
        for f in families:
            add(None, group == f, ("family", f, ""))
    for f in families:
        own = [v for v in names if family_of(v) == f]
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                rows = (label == a) | (label == b)
                add(rows, label[rows] == a, ("pair", a, b))
    return {"names": names, "families": families, "kinds": kinds,
            "planes": np.stack(planes) if planes else np.zeros((0, (1 << BITS) + 1))}


def _squash(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -10, 10)))


def margins(texts: list[bytes], planes: np.ndarray) -> np.ndarray:
    """Value of each hyperplane (rows) for each text (columns)."""
    out = np.zeros((len(planes), len(texts)))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK_BYTES):
            size += len(texts[end]) + len(_GAP)
            end += 1
        joined = b" " + _GAP.join(texts[at:end]) + b" "
        code, counts = grams(joined)
        starts = np.cumsum([0] + [len(t) + len(_GAP) for t in texts[at:end - 1]])
        if len(code):
            # One more blank, before and behind, belongs to each text.
            n = np.maximum(1, np.add.reduceat(counts.astype(np.int64), np.minimum(starts, len(code) - 1)))
            for k, plane in enumerate(planes):
                sums = np.add.reduceat(np.where(counts, plane[code], 0.0), np.minimum(starts, len(code) - 1))
                out[k, at:end] = sums / n + plane[-1]
        at = end
    return out


def predict(texts: list[bytes], model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score of each text that has letters."""
    values, kinds = margins(texts, model["planes"]), model["kinds"]
    n = len(texts)
    share = {f: np.ones(n) for f in model["families"]}
    for value, (kind, a, _) in zip(values, kinds):
        if kind == "family":
            share[a] = _squash(value)
    whole = sum(share.values())
    languages = model["names"]
    votes = {v: np.zeros(n) for v in languages}
    for value, (kind, a, b) in zip(values, kinds):
        if kind == "pair":
            votes[a] += _squash(value)
            votes[b] += 1 - _squash(value)
    chance = np.zeros((len(languages), n))
    best_family = np.stack([share[f] for f in model["families"]]).argmax(axis=0)
    for k, v in enumerate(languages):
        f = family_of(v)
        rivals = sum(family_of(o) == f for o in languages)
        within = votes[v] / (rivals * (rivals - 1) / 2) if rivals > 1 else np.ones(n)
        chance[k] = np.where(best_family == model["families"].index(f), share[f] / whole * within, -1.0)
    best = chance.argmax(axis=0)
    return [languages[k] for k in best], np.clip(chance[best, np.arange(n)], 0.0, 1.0)


def learn(labelled: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", max_rows: int = MAX_ROWS) -> dict:
    """The model of a sample of ``labelled``: at most ``max_rows`` rows, equally many of each language."""
    known = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    order = Window.partitionBy("language").orderBy("hash")
    hashed = known.select(utf8(text).alias("text"), F.col(language).alias("language"), F.xxhash64(key, text).alias("hash"))
    counts = written(hashed.select("language", "hash").distinct().groupBy("language").agg(F.count("*").alias("rows")), "languages")
    each = max(1, max_rows // max(1, counts.count()))
    # About twice as many as needed, by the hash, are ranked.
    share = F.pmod("hash", F.lit(1_000_000)) <= F.lit(1_000_000 * (2 * each + 20)) / F.col("rows")
    rows = hashed.join(counts, "language").where(share).dropDuplicates(["language", "hash"]).withColumn(
        "n", F.row_number().over(order)).where(F.col("n") <= each).select("text", "language")
    bounded_batches(labelled.sparkSession)

    def features(batches):
        for batch in batches:
            x = [frequencies(t).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(1)], names=["text", "language"])

    found = rows.mapInArrow(tidy(features), "text binary, language string").orderBy("language", "text").limit(max_rows).select(
        "language", "text").mapInArrow(tidy(packed_bytes), "language string, packed binary").toArrow()
    model = fit(_matrix(found.column(1)), found.column(0).to_pylist())
    release()
    return model


def identify(frame: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``has_letters`` to every row; the last depends on the text only."""
    bounded_batches(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in frame.columns if c not in ("lang_pred", "score", "has_letters")]
    schema = frame.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("has_letters", "boolean")

    def each(batches):
        for batch in batches:
            own = shared.value
            raw = batch.column(batch.num_columns - 1).to_pylist()
            letters = [any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in raw]
            lettered = [k for k, has in enumerate(letters) if has and own["names"]]
            names, scores = [UNKNOWN] * len(raw), np.zeros(len(raw))
            if lettered:
                best, scores[lettered] = predict([raw[k] for k in lettered], own)
                for k, v in zip(lettered, best):
                    names[k] = v
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names), pa.array(scores), pa.array(letters)], names=schema.names)

    return frame.select(*(F.col(f"`{c}`") for c in kept), utf8(text).alias("__bytes")).mapInArrow(tidy(each), schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """Per document: whether it was held out, the language of its whole text, and how sure that is."""
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")
