"""Removal of long repeated byte strings by run-length compressed Burrows-Wheeler indexes.

1. Every string of ``LENGTH`` bytes has an anchor: its smallest hashed gram of ``GRAM`` bytes, the leftmost
   of equals. Equal strings have the same anchor at the same place, so they meet under its hash. The
   strings of one anchor lie next to each other; their bytes together are its context.
2. Anchors that occur once are dropped. Contexts that occur in several texts, or several times in one,
   repeat as a whole. Only different contexts of one anchor need their bytes compared.
3. These contexts, each once, are dealt by anchor to cells of bounded size. A cell sorts its suffixes,
   keeps the runs of the transform and samples the text positions at both ends of each run. The length of
   the longest match elsewhere is computed at the samples only; in text order it falls by one from a
   sample to the next, which streams the matching statistics of all positions.
4. Anchors with more than ``CROWD`` different contexts are too many for one cell. Their strings are taken
   in slices of ``SLICE`` neighbours, known by the bytes that all of a slice share: a slice whose core no other
   context has holds no repeat, and equal slices repeat as a whole. Only the strings of different slices
   with one core, such as those at the end of a passage, are counted, by a 128-bit fingerprint.
5. The spans of a text are merged and cut out.

Work is done once for each distinct text, so copies of a text cost one row each. Null and empty texts and
texts shorter than ``LENGTH`` lose nothing. A repeated row counts as another occurrence. Strings are judged
on the input; removal takes every occurrence.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, cut_spans, merge_spans, packed_bytes, parts_for, runs, tidy, tidy_group, utf8, whole_characters
from feira.llm.suffixes import suffix_order

LENGTH = 400
GRAM = 32
CROWD = 500
SLICE = 16
CELL_BYTES = 300_000
OUT_BYTES = 8_000_000
_BITS = 20
_CHUNK = (1 << _BITS) - 1
_PLACE = np.uint64(_CHUNK)
_K1, _K2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
KEY = ("t1", "t2")


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    return np.array(np.ndarray((max(0, len(data) - 7),), "<u8", buffer=data, strides=(1,)))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    x = _words8(data)
    count = max(0, len(data) - GRAM + 1)
    h = np.zeros(count, np.uint64)
    for k in range(0, GRAM, 8):
        h += x[k:k + count]
        h *= _K1 if k % 16 == 0 else _K2
        h ^= h >> np.uint64(29)
    return h


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from minima of blocks taken forwards and backwards."""
    count = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1:width - 1 + count])


def _chunk_anchors(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int):
    """First and last string and gram hash of every anchor of the texts in a chunk, in text order."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    h = gram_hashes(data)
    least = _window_minima((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
    at = (least & _PLACE).astype(np.int64)
    edge = np.zeros(len(at) + 1, np.int64)
    fits = ends - begins >= length
    np.add.at(edge, begins[fits], 1)
    np.add.at(edge, ends[fits] - length + 1, -1)
    whole = np.cumsum(edge[:-1]) > 0
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    keep = whole[first]
    return first[keep], last[keep], h[at[first[keep]]]


def anchors(texts: list[bytes], length: int = LENGTH):
    """Of all texts: (text, first string, last string, anchor hash, context hash) arrays."""
    out, held, begins, at = [], [], [], 0

    def close():
        nonlocal held, begins, at
        if held:
            joined = b"".join(t[a:b] for _, t, a, b in held)
            data, start = np.frombuffer(joined, np.uint8), np.array(begins)
            end = np.append(start[1:], at)
            first, last, hashed = _chunk_anchors(data, start, end, length)
            of = np.searchsorted(start, first, side="right") - 1
            context = np.array([xxhash.xxh3_64_intdigest(joined[a:b + length]) for a, b in zip(first.tolist(), last.tolist())], np.uint64)
            shift = np.array([a for _, _, a, _ in held])[of] - start[of] if len(of) else of
            text = np.array([k for k, _, _, _ in held])[of] if len(of) else of
            out.append((text, first + shift, last + shift, hashed.view(np.int64), context.view(np.int64)))
        held, begins, at = [], [], 0

    for k, t in enumerate(texts):
        if len(t) < length:
            continue
        for a in range(0, len(t) - length + 1, _CHUNK - length):
            b = min(len(t), a + _CHUNK - 1)
            if at + b - a > _CHUNK:
                close()
            held.append((k, t, a, b))
            begins.append(at)
            at += b - a
    close()
    if not out:
        return (np.zeros(0, np.int64),) * 5
    return tuple(np.concatenate(x) for x in zip(*out))


def repeats_in_cell(contexts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Of each context, the spans of starts (inclusive) whose string occurs in another context too."""
    count = len(contexts)
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"\0".join(contexts) + b"\0" * 9, np.uint8)
    n = int(sizes.sum()) + count
    ends = np.cumsum(sizes + 1) - 1
    symbols = data[:n].astype(np.int64) + count
    symbols[ends] = np.arange(count)  # separators, each its own symbol
    key, width = symbols.copy(), 4
    for k in range(1, width):
        key = key * (count + 256) + np.append(symbols[k:], np.zeros(k, np.int64))
    order, _ = suffix_order(key, width)
    bwt = symbols[order - 1]
    boundary = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1  # heads of runs; the rows above are the ends of runs
    head, tail = order[boundary], order[boundary - 1]
    room = np.minimum(ends[np.searchsorted(ends, head)] - head, ends[np.searchsorted(ends, tail)] - tail)
    fits = room >= length
    head, tail, room = head[fits], tail[fits], room[fits]
    x = _words8(data)
    match, going, at = np.zeros(len(head), np.int64), np.arange(len(head)), 0
    while len(going):
        differ = x[head[going] + at] ^ x[tail[going] + at]
        low = differ & (~differ + np.uint64(1))  # lowest bit that differs
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
        match[going] = np.minimum(at + same, room[going])
        at += 8
        going = going[(differ == 0) & (room[going] > at)]
    reach = np.zeros(n, np.int64)
    np.maximum.at(reach, head, head + match)
    np.maximum.at(reach, tail, tail + match)
    long = np.maximum.accumulate(reach) - np.arange(n) >= length
    starts, stops = runs(long)
    of = np.searchsorted(ends, starts)
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for k, a, b in zip(of.tolist(), starts.tolist(), stops.tolist()):
        base = int(ends[k] - sizes[k])
        found[k].append((a - base, b - 1 - base))
    return found


def slices_of(content: bytes, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """First and last string, hash of the core and two hashes of all bytes, for each slice of a context.

    A slice holds up to ``SLICE`` neighbouring strings, counted from the anchor. Equal strings have their anchor
    at the same place, so they are in slices of the same number, and share the bytes that all strings of a whole
    slice have: its core.
    """
    last = len(content) - length
    at = int((gram_hashes(np.frombuffer(content[:length], np.uint8)) & ~_PLACE).argmin())
    found = []
    for number in range(max(0, at - last) // SLICE, at // SLICE + 1):
        high = at - number * SLICE
        low = high - SLICE + 1
        a, b = max(low, 0), min(high, last)
        core = xxhash.xxh3_64_intdigest(content[high:low + length], seed=number)
        found.append((a, b, core, *divmod(xxhash.xxh3_128_intdigest(content[a:b + length]), 1 << 64)))
    return found


def _pairs(spans) -> bytes:
    return np.array(spans, "<i4").tobytes()


def _unpaired(data: bytes) -> list[tuple[int, int]]:
    return [tuple(p) for p in np.frombuffer(data, "<i4").reshape(-1, 2).tolist()]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    data = utf8(text)
    return docs.withColumns({"t1": F.xxhash64(data), "t2": F.xxhash64(F.lit(1), data), "__bytes": data})


def _new_texts(batches, limit: int = 500_000):
    """Keys and bytes of the texts that this task has not seen before."""
    seen = set()
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        fresh = []
        for k, key in enumerate(keys):
            if key not in seen:
                seen.add(key)
                fresh.append(k)
        if len(seen) > limit:
            seen.clear()
        if fresh:
            yield batch.take(pa.array(fresh))


def _anchor_rows(length):
    def each(batches):
        for batch in _new_texts(batches):
            text, first, last, hashed, context = anchors(batch.column(2).to_pylist(), length)
            if not len(text):
                continue
            by = np.lexsort((first, context, hashed, text))
            t, h, c = text[by], hashed[by], context[by]
            new = np.concatenate(([True], (t[1:] != t[:-1]) | (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
            times = np.diff(np.append(np.flatnonzero(new), len(by)))
            within = np.repeat(times > 1, times)  # occurs again in this very text
            one = by[new]
            spans = [None] * len(one)
            for k in np.unique(t[within]).tolist():
                own = by[within & (t == k)]
                whole = merge_spans(zip(first[own].tolist(), (last[own] + length).tolist()))
                spans[int(np.flatnonzero(text[one] == k)[0])] = _pairs(whole)
            keys = batch.select([0, 1]).take(pa.array(text[one]))
            yield pa.RecordBatch.from_arrays(
                [keys.column(0), keys.column(1), pa.array(hashed[one]), pa.array(context[one]), pa.array(first[one].astype(np.int32)),
                 pa.array(last[one].astype(np.int32)), pa.array(spans, pa.binary())],
                names=["t1", "t2", "anchor", "context", "lo", "hi", "own"])

    return each


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """(t1, t2, spans) of each distinct text that has repeated strings; spans are pairs of 32-bit integers."""
    bounded_batches(docs.sparkSession)
    texts = _keyed(docs.select(F.col(text).alias("text")), "text").select("t1", "t2", "__bytes")
    copies = texts.where(F.length("__bytes") >= length).groupBy(*KEY).agg(
        F.count("*").alias("times"), F.max(F.length("__bytes")).alias("size")).where("times > 1").select(
        "t1", "t2", F.lit(0).alias("lo"), (F.col("size") - length).cast("int").alias("hi"), F.lit(None).cast("binary").alias("starts"))
    found = written(texts.mapInArrow(
        tidy(_anchor_rows(length)), "t1 long, t2 long, anchor long, context long, lo int, hi int, own binary"), "anchors")
    # Anchors of several contexts or texts.
    shared = found.groupBy("anchor").agg(
        F.min("context").alias("c0"), F.max("context").alias("c1"), F.min("t1").alias("k0"), F.max("t1").alias("k1")).where(
        "c0 <> c1 OR k0 <> k1").select("anchor")
    live = written(found.drop("own").join(shared, "anchor", "left_semi"), "live")
    contexts = live.groupBy("anchor", "context").agg(
        F.min("t1").alias("k0"), F.max("t1").alias("k1"), F.max(F.col("hi") - F.col("lo")).alias("more"))
    contexts = written(contexts, "contexts")
    crowds = contexts.groupBy("anchor").agg(F.count("*").alias("crowd")).where("crowd > 1")
    mixed = written(contexts.join(crowds, "anchor").select("anchor", "context", "k0", "crowd", "more"), "mixed")

    # The bytes of each context that has rivals, from one text that holds it.
    wanted = live.join(mixed, ["anchor", "context"]).where("t1 = k0").groupBy(*KEY).agg(
        F.collect_list(F.struct("anchor", "context", "lo", "hi", (F.col("crowd") > crowd).alias("crowded"))).alias("places"))

    def newpacked_bytes(batches):
        return packed_bytes(_new_texts(batches))

    def contents(batches):
        unpacker, names = zstandard.ZstdDecompressor(), ["anchor", "context", "crowded", "content"]
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        for batch in batches:
            rows, size = [], 0
            for packed, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = unpacker.decompress(packed)
                for p in places:
                    rows.append((p["anchor"], p["context"], p["crowded"], data[p["lo"]:p["hi"] + length]))
                    size += len(rows[-1][3])
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    packed = texts.mapInArrow(tidy(newpacked_bytes), "t1 long, t2 long, packed binary")
    content = written(packed.join(wanted, list(KEY)).select("packed", "places").mapInArrow(
        tidy(contents), "anchor long, context long, crowded boolean, content binary"), "contents")
    size = mixed.agg(F.sum(F.col("more") + length)).first()[0] or 0

    def cell_work(table: pa.Table) -> pa.Table:
        rows = {(a, c): t for a, c, t in zip(*(table.column(k).to_pylist() for k in ("anchor", "context", "content")))}
        spans = repeats_in_cell(list(rows.values()), length)
        hit = [(key, s) for key, s in zip(rows, spans) if s]
        return pa.Table.from_arrays(
            [pa.array([k[0] for k, _ in hit], pa.int64()), pa.array([k[1] for k, _ in hit], pa.int64()),
             pa.array([_pairs(s) for _, s in hit], pa.binary())], names=["anchor", "context", "starts"])

    schema = "anchor long, context long, starts binary"
    few = content.where("NOT crowded").withColumn("cell", F.pmod(F.xxhash64("anchor"), F.lit(parts_for(size, CELL_BYTES)))).groupBy(
        "cell").applyInArrow(tidy_group(cell_work), schema)

    def sliced(batches):
        for batch in batches:
            anchor, context, data = (batch.column(k) for k in (0, 1, 3))
            found = [(k, *x) for k, t in enumerate(data.to_pylist()) for x in slices_of(t, length)]
            of, a, b, core, w1, w2 = zip(*found) if found else ((),) * 6
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [anchor.take(of), context.take(of), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                 *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (core, w1, w2))],
                names=["anchor", "context", "a", "b", "core", "w1", "w2"])

    def fingerprints(batches):
        names, kinds = ["anchor", "context", "at", "f1", "f2"], (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for k in (k for s in row["slices"] for k in range(s["a"], s["b"] + 1)):
                    high, low = divmod(xxhash.xxh3_128_intdigest(row["content"][k:k + length]), 1 << 64)
                    rows.append((row["anchor"], row["context"], k, high - (1 << 63), low - (1 << 63)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    # Equal strings lie in slices with the same core. Slices that are equal as a whole repeat as a whole; only different
    # ones with the same core are opened, one of each.
    crowded = content.where("crowded")
    core, whole = ["anchor", "core"], ["anchor", "core", "w1", "w2"]
    parts = written(crowded.mapInArrow(
        tidy(sliced), "anchor long, context long, a int, b int, core long, w1 long, w2 long"), "slices")
    met = parts.join(parts.groupBy(core).agg(F.min("context").alias("c0"), F.max("context").alias("c1")).where("c0 <> c1"), core, "left_semi")
    wholes = met.groupBy(whole).agg(F.min(F.struct("context", "a", "b")).alias("one"), F.max("context").alias("other"))
    alike = met.join(wholes.where("one.context <> other"), whole, "left_semi").select("anchor", "context", "a", "b")
    differ = wholes.groupBy(core).agg(F.count("*").alias("kinds")).where("kinds > 1")
    opened = wholes.join(differ, core, "left_semi").groupBy("anchor", F.col("one.context").alias("context")).agg(
        F.collect_list(F.struct("one.a", "one.b")).alias("slices"))
    strings = written(crowded.join(opened, ["anchor", "context"]).select("anchor", "context", "content", "slices").mapInArrow(
        tidy(fingerprints), "anchor long, context long, at int, f1 long, f2 long"), "strings")
    several = strings.groupBy("f1", "f2").agg(F.min("context").alias("c0"), F.max("context").alias("c1")).where("c0 <> c1")
    hit = strings.join(several, ["f1", "f2"], "left_semi").select("anchor", "context", F.col("at").alias("a"), F.col("at").alias("b"))
    many = hit.union(alike).groupBy("anchor", "context").agg(F.collect_list(F.struct("a", "b")).alias("at"))

    def joined_starts(batches):
        for batch in batches:
            spans = [_pairs([(a, b - 1) for a, b in merge_spans((x["a"], x["b"] + 1) for x in at)]) for at in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.binary())], names=["anchor", "context", "starts"])

    partly = few.union(many.mapInArrow(tidy(joined_starts), schema))
    several_texts = contexts.where("k0 <> k1").select("anchor", "context", F.lit(None).cast("binary").alias("starts"))
    partly = partly.join(several_texts.select("anchor", "context"), ["anchor", "context"], "left_anti")
    marks = live.join(partly.union(several_texts), ["anchor", "context"]).select("t1", "t2", "lo", "hi", "starts")
    own = found.where("own IS NOT NULL").select("t1", "t2", F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), F.col("own").alias("starts"))
    gathered = marks.union(own).union(copies).groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi", "starts")).alias("marks"))

    def merged(batches):
        for batch in batches:
            out = []
            for own_marks in batch.column(2).to_pylist():
                spans = []
                for m in own_marks:
                    if m["lo"] < 0:  # spans of the text itself
                        spans += _unpaired(m["starts"])
                    elif m["starts"] is None:
                        spans.append((m["lo"], m["hi"] + length))
                    else:
                        spans += [(m["lo"] + a, m["lo"] + b + length) for a, b in _unpaired(m["starts"])]
                out.append(_pairs(merge_spans(spans)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["t1", "t2", "spans"])

    return written(gathered.mapInArrow(tidy(merged), "t1 long, t2 long, spans binary"), "spans")


def _with_spans(docs: DataFrame, text: str, length: int, crowd: int) -> DataFrame:
    """All rows of ``docs`` without the text, with its packed bytes and its spans (null: none)."""
    spans = repeated_spans(docs, text, length, crowd)
    others = [c for c in docs.columns if c != text]
    keyed = _keyed(docs.select(*others, F.col(text).alias("__text")), "__text").withColumn("__null", F.col("__text").isNull())
    named = [c for c in keyed.columns if c not in ("__text", "__bytes")]
    schema = keyed.select(*named).schema.add("packed", "binary")
    packed = keyed.select(*named, "__bytes").mapInArrow(tidy(packed_bytes), schema)
    return packed.join(spans, list(KEY), "left").drop(*KEY)


def kept_digests(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, and the digest of what is left."""
    def each(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("packed", "spans")}
            sizes, removed, count, digest = [], [], [], []
            for packed, spans in zip(columns["packed"], columns["spans"]):
                data, own = unpacker.decompress(packed), _unpaired(spans) if spans else []
                sizes.append(len(data))
                removed.append(sum(b - a for a, b in own))
                count.append(len(own))
                digest.append(hashlib.sha256(cut_spans(data, own)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, count)), pa.array(digest)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(docs.select("doc_id", "text"), "text", length, crowd)
    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    return rows.mapInArrow(tidy(each), schema)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts; a character that would be cut in two stays."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    at = docs.columns.index(text)
    rows = _with_spans(plain, f"c{at}", length, crowd)
    order, names = plain.columns, docs.columns

    def each(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            kept = []
            for packed, spans, null in zip(*(batch.column(c).to_pylist() for c in ("packed", "spans", "__null"))):
                data = unpacker.decompress(packed)
                own = whole_characters(data, _unpaired(spans)) if spans else []
                kept.append(None if null else cut_spans(data, own).decode("utf-8", "replace"))
            made = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([made if c == f"c{at}" else batch.column(c) for c in order], names=names)

    return rows.mapInArrow(tidy(each), docs.schema)
