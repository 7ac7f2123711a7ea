"""Benchmark decontamination by an FM-index over each training shard.

Words are looked up in the vocabulary of the benchmark. Only stretches in which every two neighbouring
words are also neighbours in the benchmark can hold a test phrase, so only those are indexed: a suffix
order gives their Burrows-Wheeler transform, a wavelet matrix its ranks. All test phrases are searched
backwards at once, occurrences are located by walking to sampled suffix positions, and the spans of all
occurrences of a text are merged.

A phrase is ``WINDOW`` consecutive words of an item, or the whole item if it has fewer. The benchmark is
a query set: up to ``BLOCK_BYTES`` of it go to the tasks at once, a larger one is searched block by block;
the spans of the blocks are then merged for each text.

Null or empty texts have no words. Items without words have no phrase; an item without id marks words
but is not counted. Repeated items, phrases or rows change nothing. Without a benchmark nothing is hit.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.shared import bounded_batches, cut_spans, merge_spans, parts_for, runs, tidy, utf8
from feira.llm.suffixes import suffix_order

WINDOW = 10
BLOCK_BYTES = 2_000_000
SHARD_BYTES = 4_000_000
SAMPLE_EVERY = 8

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
SPANS = "array<struct<start:int,end:int>>"
FOUND = f"n_words long, n_hit long, word_spans {SPANS}, byte_spans {SPANS}, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Phrases:
    """The distinct test phrases of a block of items, with what the search needs of them."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: k for k, name in enumerate(self.names)}
        found: dict[tuple[int, ...], set[int]] = {}
        pairs = set()
        for name, text in items:
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            pairs.update(zip(own, own[1:]))
            for at in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(tuple(own[at:at + window]), set()).update([number[name]] if name is not None else [])
        self.size = len(self.ids) + 1
        self.pairs = np.array(sorted(a * self.size + b for a, b in pairs), np.int64)
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.symbols = np.zeros((len(found), window), np.int64)  # right-aligned
        for k, phrase in enumerate(found):
            self.symbols[k, window - len(phrase):] = phrase
        self.items = [sorted(x) for x in found.values()]

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the stretches of words that can hold a phrase."""
        known = ids > 0
        left = np.flatnonzero(known[:-1] & known[1:])
        key = ids[left].astype(np.int64) * self.size + ids[left + 1]
        at = np.minimum(np.searchsorted(self.pairs, key), max(0, len(self.pairs) - 1))
        linked = np.zeros(len(ids) + 1, bool)
        if len(self.pairs):
            linked[left[self.pairs[at] == key] + 1] = True
        starts = np.flatnonzero(known & ~linked[:-1])
        ends = np.flatnonzero(known & ~linked[1:]) + 1
        enough = ends - starts >= self.lengths.min()
        return starts[enough], ends[enough]


class FMIndex:
    """Burrows-Wheeler transform of word numbers with wavelet-matrix ranks; 0 separates stretches."""

    def __init__(self, symbols: np.ndarray):
        n, breaks = len(symbols), np.flatnonzero(symbols == 0)
        first = symbols.astype(np.int64) + len(breaks)
        first[breaks] = np.arange(len(breaks))
        order, _ = suffix_order(first)
        self.n, self.bwt = n, symbols[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1))))
        self.levels = []
        part = self.bwt
        for bit in reversed(range(int(symbols.max()).bit_length())):
            ones = (part >> bit) & 1
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones))), n - int(ones.sum())))
            part = np.concatenate((part[ones == 0], part[ones == 1]))
        self.sampled = (order % SAMPLE_EVERY == 0) | (self.bwt == 0)
        self.position = np.where(self.sampled, order, -1)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Row that the backward step by ``symbol`` leads to."""
        low, high = np.zeros_like(at), at
        for bit, ones, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return self.before[symbol] + high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) row of each right-aligned phrase."""
        first, last = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[:, k]
            go = (symbol > 0) & (first < last) & (symbol < len(self.before) - 1)
            gone = (symbol > 0) & ~go
            first[go], last[go] = self.step(symbol[go], first[go]), self.step(symbol[go], last[go])
            last[gone] = first[gone]
        return first, last

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to a sampled suffix, then adds the steps."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            at = rows[walking]
            rows[walking] = self.step(self.bwt[at], at)
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.position[rows] + steps


def search_shard(texts: list[bytes], phrases: Phrases) -> list[dict]:
    """What ``FOUND`` holds, for each text of a shard."""
    get, parts, counts = phrases.ids.get, [], []
    for text in texts:
        own = words_of(text)
        counts.append(len(own))
        parts += [np.fromiter(map(get, own, repeat(0)), np.int64, len(own)), np.zeros(1, np.int64)]
    ids = np.concatenate(parts)
    begins = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))
    covered, items = np.zeros(len(ids) + 1, np.int64), {}
    starts, ends = phrases.stretches(ids) if len(phrases.lengths) else (np.zeros(0, np.int64),) * 2
    if len(starts):
        length = ends - starts + 1  # with a separator behind
        word_at = np.repeat(starts - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        symbols = ids[word_at]
        symbols[np.cumsum(length) - 1] = 0
        index = FMIndex(symbols)
        first, last = index.search(phrases.symbols)
        which = np.repeat(np.arange(len(first)), last - first)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[which]
        begin = word_at[index.locate(rows)]
        np.add.at(covered, begin, 1)
        np.add.at(covered, begin + phrases.lengths[which], -1)
        text_of = np.searchsorted(begins, begin, side="right") - 1
        for doc, phrase in np.unique(np.stack((text_of, which)), axis=1).T.tolist():
            items.setdefault(doc, set()).update(phrases.items[phrase])
    from_word, to_word = runs(np.cumsum(covered[:-1]) > 0)
    at = np.searchsorted(from_word, begins)
    found = []
    for k, text in enumerate(texts):
        own = [(int(a - begins[k]), int(b - begins[k])) for a, b in zip(from_word[at[k]:at[k + 1]], to_word[at[k]:at[k + 1]])]
        places = [m.span() for m in _WORD.finditer(text.lower())] if own else []
        found.append({
            "n_words": counts[k], "n_hit": sum(b - a for a, b in own), "word_spans": own,
            "byte_spans": [(places[a][0], places[b - 1][1]) for a, b in own],
            "items": sorted(phrases.names[i] for i in items.get(k, ()))})
    return found


def _pass(frame: DataFrame, phrases: Phrases) -> DataFrame:
    """``frame`` (its last column the bytes of the texts) with the columns of ``FOUND`` in place of the bytes."""
    shared = frame.sparkSession.sparkContext.broadcast(phrases)
    kept = frame.columns[:-1]
    schema = frame.select(*kept).schema
    for column in frame.sparkSession.createDataFrame([], FOUND).schema:
        schema = schema.add(column)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    types = {"n_words": pa.int64(), "n_hit": pa.int64(), "word_spans": spans, "byte_spans": spans, "items": pa.list_(pa.string())}

    def each(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= SHARD_BYTES:
                yield shard(held)
                held, size = [], 0
        if held:
            yield shard(held)

    def shard(held):
        rows = pa.Table.from_batches(held)
        found = search_shard(rows.column(rows.num_columns - 1).to_pylist(), shared.value)
        made = [pa.array([[{"start": a, "end": b} for a, b in x[c]] for x in found] if c.endswith("spans") else [x[c] for x in found], t)
                for c, t in types.items()]
        columns = [rows.column(i).combine_chunks() for i in range(len(kept))]
        return pa.RecordBatch.from_arrays([*columns, *made], names=schema.names)

    return frame.mapInArrow(tidy(each), schema)


def _block(items: DataFrame, item: str, text: str, blocks: int, k: int) -> Phrases:
    chosen = items.where(F.pmod(F.xxhash64(item, text), F.lit(blocks)) == k)
    return Phrases([(r[0], bytes(r[1])) for r in chosen.select(F.col(item).cast("string"), utf8(text)).distinct().collect()])


def find_phrases(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows of ``docs`` with the columns of ``FOUND``: words, words hit, merged spans, items found."""
    bounded_batches(docs.sparkSession)
    docs = docs.select([c for c in docs.columns if c not in ("n_words", "n_hit", "word_spans", "byte_spans", "items")])
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = parts_for(size, block_bytes)
    source = docs.withColumn("__bytes", utf8(text))
    if blocks == 1:
        return _pass(source, _block(items, item, item_text, 1, 0))
    # The spans of each block meet at the text they belong to.
    texts = source.select(F.sha2("__bytes", 256).alias("__key"), "__bytes")
    found = None
    for k in range(blocks):
        part = _pass(texts, _block(items, item, item_text, blocks, k)).dropDuplicates(["__key"])
        found = part if found is None else found.union(part)
    together = found.groupBy("__key").agg(
        F.max("n_words").alias("n_words"),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("word_spans", "byte_spans")),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def merged(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                for c in ("word_spans", "byte_spans"):
                    row[c] = [{"start": a, "end": b} for a, b in merge_spans((s["start"], s["end"]) for s in row[c])]
                row["n_hit"] = sum(s["end"] - s["start"] for s in row["word_spans"])
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema.append(pa.field("n_hit", pa.int64())))

    merged_rows = together.mapInArrow(tidy(merged), f"__key string, n_words long, word_spans {SPANS}, byte_spans {SPANS}, items array<string>, n_hit long")
    joined = source.withColumn("__key", F.sha2("__bytes", 256)).drop("__bytes").join(merged_rows, "__key")
    return joined.select(*docs.columns, "n_words", "n_hit", "word_spans", "byte_spans", "items")


def remove_phrases(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every occurrence cut out of the texts; all other columns and texts stay."""
    at = docs.columns.index(text)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # whatever the columns are called
    found = find_phrases(plain, items, f"c{at}", **options).select(*plain.columns, "byte_spans")
    names = docs.columns

    def each(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            spans = batch.column(batch.num_columns - 1).to_pylist()
            cut = [cut_spans(t.encode(), [(s["start"], s["end"]) for s in own]).decode() if own else t for t, own in zip(texts, spans)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(cut, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(tidy(each), docs.schema)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, words hit, number and digest of the items found in it."""
    found = find_phrases(docs.select("doc_id", "text"), items.select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
