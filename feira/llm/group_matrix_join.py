"""Jaccard self-join on word shingles by a token-group matrix, for connected groups of documents.

1. Each text becomes the set of its distinct shingles (64-bit hashes). Equal sets are one class.
2. Two sets with similarity of at least ``SIMILAR`` share several shingles among the first of each, in any
   common order: a prefix of n - needed(n) + n / ``DEPTH`` shingles has at least needed(n) / ``DEPTH`` in
   common with that of any similar set. Shingles that are frequent in a sample come last in that order;
   the sample only moves work, never results. Sets that share fewer with all others take no further part.
   Of the whole sets that are left, those with too few shingles in others of them also go.
3. Sets with the same first shared shingle and about the same size form a group, large ones several blocks of bounded size with
   some common members (hubs). Within a block all sets are compared; each gets the label of its connected
   part, and parts that hold the same hub share one label.
4. Sets that share rare shingles with other labels are grouped anew, by the shingles that they have exactly in
   common with the same other sets (a kind, such as a passage) and by size, and query the blocks of other labels.
   The matrix of kinds and blocks tells which blocks hold one of the rarest kinds of the query, as many as a similar
   set can't do without, and members of a fitting size. Such a block travels with the union of its members'
   shingles: if too little of the query lies in it, no member can be similar and the block stays closed. Only
   opened blocks are compared with the query.
5. Links between labels are closed to components.

No step lists all pairs of a group: a block gives each member one label, and shingles whose sets all have
one label are dropped before step 4.

A text with fewer words than a shingle is its whole word sequence as one shingle. Null or empty texts, or
texts without words, have no shingles, are linked with nothing and are components of their own. Repeated
rows are in one component. A null id is ignored when the smallest id is taken.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.components import components, written
from feira.llm.shared import bounded_batches, packed_bytes, parts_for, tidy, tidy_group, utf8

WORDS = 5
SIMILAR = 75  # per cent
DEPTH = 8
SAMPLE_ROWS = 4000  # texts that decide which shingles count as frequent
FREQUENT = 50_000  # shingles that can be frequent
BLOCK_SETS = 256
HUBS = 4
BLOCK_BYTES = 1_000_000
CELL_BYTES = 4_000_000
QUERIES_AT_ONCE = 512
COUNTED = 2000
_MASK = np.uint64((1 << 62) - 1)
_LAST = np.int64(1 << 62)  # set in frequent shingles, so that they sort behind all others


class _WordHashes(dict):
    """64-bit hash of each word, kept for the words seen so far (a bounded number)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes, hashes: _WordHashes, words: int, frequent: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of a text; frequent ones behind the others."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
    width = min(words, len(own))
    x = np.full(len(own) - width + 1, width, np.uint64)
    for k in range(width):
        x = _mix(x + h[k:len(h) - width + 1 + k])
    x = np.unique((x & _MASK).astype(np.int64))
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)
        often = frequent[at] == x
        x = np.concatenate((x[~often], x[often] | _LAST))
    return x


def needed(n):
    """Shared shingles that a set of ``n`` needs at least with any similar set."""
    return (SIMILAR * n + 99) // 100


def prefix_size(n: int) -> int:
    return n - needed(n) + -(-n // DEPTH)


def in_common(n):
    """Prefix shingles that a set of ``n`` shares at least with any similar set."""
    return (needed(n) + DEPTH - 1) // DEPTH


def similar(both, n, m):
    return 100 * both >= SIMILAR * (n + m - both)


def _frequent(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """Shingles of several texts of the sample: a bounded table, taken by a hash of the text."""
    rows = docs.count()
    chosen = docs.where(F.pmod(F.xxhash64(text), F.lit(parts_for(rows, SAMPLE_ROWS))) == 0)

    def tokens(batches):
        hashes, none = _WordHashes(), np.zeros(0, np.int64)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(part, hashes, words, none))], names=["token"])

    counted = chosen.select(utf8(text).alias("t")).distinct().mapInArrow(tidy(tokens), "token long").groupBy("token").count()
    often = counted.where(F.col("count") >= 3).orderBy(F.desc("count"), "token").limit(FREQUENT).toArrow()
    return np.sort(often.column(0).to_numpy())


def _sets(docs: DataFrame, text: str, words: int, frequent) -> DataFrame:
    """Per row: its other columns, number of shingles, hash of the set, and the prefix that any similar set must meet."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others).schema.add("n", "long").add("sig", "long").add("prefix", "binary")

    def each(batches):
        hashes = _WordHashes()
        for batch in batches:
            n, sig, prefix = [], [], []
            for t in batch.column(len(others)).to_pylist():
                x = shingle_set(t, hashes, words, frequent.value)
                n.append(len(x))
                sig.append(xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63))
                prefix.append(x[:prefix_size(len(x))].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(others))), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(prefix, pa.binary())],
                names=schema.names)

    return docs.select(*others, utf8(text).alias("__bytes")).mapInArrow(tidy(each), schema)


def _unseen(column, seen: set[int]) -> pa.Array:
    """Whether each value is new to this task, as far as a bounded memory tells."""
    if len(seen) > 500_000:
        seen.clear()
    out = []
    for value in column.to_pylist():
        out.append(value not in seen)
        seen.add(value)
    return pa.array(out, pa.bool_())


def _each_text_once(batches):
    """Rows (text_hash, text), those of equal texts once per task: copies come down before they are shuffled."""
    seen: set[int] = set()
    for batch in batches:
        yield batch.filter(_unseen(batch.column(0), seen))


def _prefix_tokens(batches):
    """(token, sig) of every set, once per task."""
    seen = set()
    for batch in batches:
        sigs, blobs = [], []
        for sig, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if prefix and sig not in seen:
                seen.add(sig)
                sigs.append(sig)
                blobs.append(np.frombuffer(prefix, np.int64))
        if len(seen) > 500_000:
            seen.clear()
        if blobs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(blobs)), pa.array(np.repeat(np.array(sigs), [len(b) for b in blobs]))],
                names=["token", "sig"])


def _each_token(batches):
    """(sig, token) of whole sets."""
    for batch in batches:
        blobs = [np.frombuffer(t, np.int64) for t in batch.column(1).to_pylist()]
        if blobs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), [len(b) for b in blobs])), pa.array(np.concatenate(blobs))], names=["sig", "token"])


def _shared_only(batches):
    """Of rows sorted by token and sig, those whose token belongs to several sets, with the number of these.

    Runs of up to ``COUNTED`` rows are held until they end; all longer ones stream through as
    ``COUNTED`` + 1, so that every row of a token has the same number.
    """
    held: list[int] = []  # sigs of the run at the end of what was read
    token, streaming = None, False

    def rows(t, s, count):
        return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(s, pa.int64()), pa.array(count, pa.int32())], names=["token", "sig", "met_by"])

    for batch in batches:
        t, s = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(t):
            continue
        if token is not None:
            t, s = np.concatenate((np.full(len(held), token), t)), np.concatenate((np.array(held, np.int64), s))
        new = np.concatenate(([True], (t[1:] != t[:-1]) | (s[1:] != s[:-1])))
        t, s = t[new], s[new]
        run = np.cumsum(np.concatenate(([True], t[1:] != t[:-1]))) - 1
        size = np.bincount(run)
        count = np.minimum(size, COUNTED + 1)
        first_goes_on = streaming and token == t[0]
        if first_goes_on:
            count[0] = COUNTED + 1
        last = int(run[-1])
        streaming = count[last] > COUNTED
        out = (count[run] > 1) & ((run < last) | streaming)
        if first_goes_on:
            out[0] = False  # held only to tell repeats; it went out before
        token, tail = int(t[-1]), s[run == last]
        held = [int(tail[-1])] if streaming else tail.tolist()
        if out.any():
            yield rows(t[out], s[out], count[run][out])
    if token is not None and not streaming and len(held) > 1:
        yield rows(np.full(len(held), token), np.array(held, np.int64), np.full(len(held), len(held)))


class Members:
    """Sets of one block with the union of their shingles."""

    def __init__(self, sigs: list[int], sets: list[np.ndarray]):
        self.sigs, self.sets = sigs, sets
        self.sizes = np.array([len(x) for x in sets], np.int64)
        tokens = np.concatenate(sets)
        self.union, self.column = np.unique(tokens, return_inverse=True)
        self.member = np.repeat(np.arange(len(sets)), self.sizes)

    def overlaps(self) -> np.ndarray:
        """Sizes of all intersections, by products of slices of the member-token matrix."""
        count = len(self.sets)
        total = np.zeros((count, count), np.float32)
        often = np.bincount(self.column, minlength=len(self.union)) > 1
        number = np.cumsum(often) - 1
        kept = often[self.column]
        column, member = number[self.column[kept]], self.member[kept]
        by = np.argsort(column, kind="stable")
        column, member = column[by], member[by]
        width = 8192
        for start in range(0, int(often.sum()), width):
            a, b = np.searchsorted(column, (start, start + width))
            part = np.zeros((count, width), np.float32)
            part[member[a:b], column[a:b] - start] = 1
            total += part @ part.T
        return total.astype(np.int64)

    def labels(self) -> list[int]:
        """Label of each member: the smallest member that it is connected with."""
        linked = similar(self.overlaps(), self.sizes[:, None], self.sizes[None, :])
        label: list[int | None] = [None] * len(self.sigs)
        for k in range(len(self.sigs)):
            if label[k] is None:
                reach = np.zeros(len(self.sigs), bool)
                front = reach.copy()
                front[k] = True
                while front.any():
                    reach |= front
                    front = linked[front].any(axis=0) & ~reach
                connected = np.flatnonzero(reach).tolist()
                least = min(self.sigs[m] for m in connected)
                for m in connected:
                    label[m] = least
        return label

    def similar_to(self, x: np.ndarray) -> np.ndarray:
        """Members similar to ``x``; if the union leaves no room for one, none is looked at."""
        at = np.minimum(np.searchsorted(self.union, x), len(self.union) - 1)
        at = at[self.union[at] == x]
        if len(at) < needed(len(x)):
            return np.zeros(0, np.int64)
        own = np.zeros(len(self.union), bool)
        own[at] = True
        both = np.bincount(self.member[own[self.column]], minlength=len(self.sets))
        return np.flatnonzero(similar(both, len(x), self.sizes))


def _each_block(table: pa.Table, work, names: list[str], kinds: list):
    """Applies ``work`` to the rows of each block of a cell."""
    rows = {}
    for row in table.to_pylist():
        rows.setdefault(row["block"], []).append(row)
    out = list(chain.from_iterable(work(own) for own in rows.values()))
    return pa.Table.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)


def _unique(rows: list[dict]) -> list[dict]:
    return list({r["sig"]: r for r in rows}.values())


def _label_block(rows):
    rows = _unique(sorted(rows, key=lambda r: r["home"]))  # a hub may also be at home here
    block = Members([r["sig"] for r in rows], [np.frombuffer(r["tokens"], np.int64) for r in rows])
    return [(r["sig"], label, r["home"], r["hub"]) for r, label in zip(rows, block.labels())]


def _query_block(rows):
    members = _unique([r for r in rows if not r["asks"]])
    if not members:
        return
    block = Members([r["sig"] for r in members], [np.frombuffer(r["tokens"], np.int64) for r in members])
    found = set()
    for q in _unique([r for r in rows if r["asks"]]):
        for k in block.similar_to(np.frombuffer(q["tokens"], np.int64)).tolist():
            if members[k]["label"] != q["label"]:
                found.add((members[k]["label"], q["label"]))
    yield from found


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                       block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: key, n_shingles and component_id (smallest key of its connected group)."""
    rows = _component_rows(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), words, block_sets, block_bytes)
    least = rows.where("n > 0").groupBy("component").agg(F.min("key").alias("least"))
    return rows.join(least, "component", "left").select(
        "key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component_id"))


def _component_rows(docs: DataFrame, words: int = WORDS, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (key, text, others): its columns but the text, number of shingles n, and component."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.withColumn("text_hash", F.xxhash64(utf8("text")))
    frequent = spark.sparkContext.broadcast(_frequent(docs, "text", words))
    sets = written(_sets(docs, "text", words, frequent), "sets")
    tokens = sets.select("sig", "prefix").mapInArrow(tidy(_prefix_tokens), "token long, sig long")
    postings = tokens.repartition("token").sortWithinPartitions("token", "sig").mapInArrow(
        tidy(_shared_only), "token long, sig long, met_by int")

    # Of two similar sets the rarest common shingle has as many common ones behind it as the bound asks for,
    # so the most frequent of a set need not be looked up.
    # A class of equal sets is known by one of its texts, not by an id: many rows may share an id or have none.
    classes = sets.groupBy("sig").agg(F.min("text_hash").alias("text_hash"), F.first("n").alias("n"))
    own = Window.partitionBy("sig")
    bound = F.expr(f"((({SIMILAR} * n + 99) div 100) + {DEPTH - 1}) div {DEPTH}")
    posted = written(postings.withColumns({
        "met": F.count("*").over(own), "grp": F.min("token").over(own),
        "nth": F.row_number().over(own.orderBy("met_by", "token"))}).join(classes, "sig").where(
        (F.col("met") >= bound) & (F.col("nth") <= F.col("met") - bound + 1)).select("sig", "token", "grp", "text_hash", "n"), "posted")

    # The whole sets of those that are left: of each, the share needed must lie in others of them.
    wanted = posted.groupBy("sig").agg(*(F.first(c).alias(c) for c in ("grp", "text_hash", "n")))
    packed = docs.select("text_hash", utf8("text").alias("t")).mapInArrow(tidy(_each_text_once), "text_hash long, t binary").mapInArrow(
        tidy(packed_bytes), "text_hash long, packed binary")

    def full_sets(batches):
        hashes, unpacker, seen = _WordHashes(), zstandard.ZstdDecompressor(), set()
        for batch in batches:
            new = _unseen(batch.column(0), seen)
            batch = batch.filter(new)
            x = [shingle_set(unpacker.decompress(t), hashes, words, frequent.value) for t in batch.column(1).to_pylist()]
            made = pa.array([xxhash.xxh3_64_intdigest(v.tobytes()) - (1 << 63) for v in x], pa.int64())
            fits = pc.equal(made, batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [made, pa.array([v.tobytes() for v in x], pa.binary()), batch.column(2), batch.column(3)],
                names=["sig", "tokens", "grp", "n"]).filter(fits)

    full = written(packed.join(wanted, "text_hash").select("sig", "packed", "grp", "n")
                   .mapInArrow(tidy(full_sets), "sig long, tokens binary, grp long, n long"), "full")
    lively = full.select("sig", "tokens").mapInArrow(tidy(_prefix_tokens), "token long, sig long").repartition("token").sortWithinPartitions(
        "token", "sig").mapInArrow(tidy(_shared_only), "token long, sig long, met_by int").groupBy("sig").agg(F.count("*").alias("met"))
    left = written(full.select("sig", "grp", "n").distinct().join(lively, "sig").where(
        F.col("met") >= F.expr(f"({SIMILAR} * n + 99) div 100")).drop("met"), "left")

    # Groups by the first shared shingle and the size of the set, so that a query opens blocks of fitting size only,
    # in blocks; each block of a large group also gets its hubs.
    step = F.floor(F.log(F.col("n")) / float(np.log(100 / SIMILAR)))
    left = left.withColumn("grp", F.xxhash64("grp", step))
    sizes = left.groupBy("grp").agg(
        F.count("*").alias("members"), F.sum("n").alias("weight"),
        F.array_compact(F.array(*(F.min(F.when(F.pmod("sig", F.lit(HUBS)) == k, F.col("sig"))) for k in range(HUBS)))).alias("hubs"))
    placed = left.join(sizes, "grp").withColumn("blocks", F.greatest(
        F.ceil(F.col("members") / block_sets), F.ceil(F.col("weight") * 8 / block_bytes)).cast("long"))
    placed = written(placed.select("sig", "n", "hubs", "blocks", F.xxhash64(
        "grp", F.pmod(F.xxhash64("sig"), "blocks")).alias("block")), "placed")
    weight = placed.agg(F.sum("n") * 8).first()[0] or 0
    sets_of = full.select("sig", "tokens")
    members = placed.select("sig", "block", F.lit(True).alias("home"), (F.array_contains("hubs", F.col("sig")) & (F.col("blocks") > 1)).alias("hub"))
    guests = placed.where("blocks > 1").select(F.explode("hubs").alias("sig"), "block", F.lit(False).alias("home"), F.lit(True).alias("hub")).distinct()
    first = members.union(guests).join(sets_of, "sig").withColumn("cell", F.pmod("block", F.lit(parts_for(weight, CELL_BYTES))))
    local = written(first.groupBy("cell").applyInArrow(
        tidy_group(lambda t: _each_block(t, _label_block, ["sig", "label", "home", "hub"], [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()])),
        "sig long, label long, home boolean, hub boolean"), "local")
    joined = components(local.where("hub").select(F.col("label").alias("a"), F.col("sig").alias("b")))
    labels = local.where("home").groupBy("sig").agg(F.min("label").alias("l")).join(joined, F.col("l") == F.col("key"), "left").select(
        "sig", F.coalesce("root", "l").alias("label"))
    labels = written(labels, "labels")

    # Sets whose rare prefix shingles join several labels go on with all their shingles, each set once.
    looked_up = posted.select("sig", "token").join(labels, "sig")
    mixed = looked_up.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    crowd = labels.groupBy("label").agg(F.count("*").alias("crowd"))
    met = looked_up.join(mixed, "token").select("sig").distinct()
    known = written(placed.select("sig", "n").join(met, "sig").join(labels, "sig").join(crowd, "label").select(
        "sig", "n", "label", F.struct("crowd", "label").alias("rank")), "known")
    own_sets = written(sets_of.join(met, "sig", "left_semi").dropDuplicates(["sig"]), "own")
    rows = written(own_sets.mapInArrow(tidy(_each_token), "sig long, token long"), "rows")

    # Shingles that lie in the same sets, such as those of one passage, are of one kind. Sets of different labels
    # can have in common only what joins labels; of that, in any common order, the first shingle that two similar
    # sets share has all others they share behind it. So a set with too few drops out, and one asks, and is asked, by its
    # rarest kinds only.
    kinds = rows.join(known.select("sig", "label"), "sig").groupBy("token").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("spread"),
        F.xxhash64(F.bit_xor(F.xxhash64("sig")), F.bit_xor(F.xxhash64(F.lit(1), "sig")), F.count("*")).alias("kind")).where(
        "lo <> hi").groupBy("kind").agg(F.min("token").alias("token"), F.count("*").alias("tokens"), F.max("spread").alias("spread"))
    by_set = Window.partitionBy("sig")
    earlier = by_set.orderBy("spread", "kind").rowsBetween(Window.unboundedPreceding, -1)
    share = F.expr(f"({SIMILAR} * n + 99) div 100")
    held = rows.join(kinds, "token").join(known, "sig").withColumns({
        "met": F.sum("tokens").over(by_set), "before": F.coalesce(F.sum("tokens").over(earlier), F.lit(0)),
        "main": F.max(F.struct(F.col("tokens") * F.col("spread"), "kind")).over(by_set)}).where((F.col("met") >= share) & (F.col("before") <= F.col("met") - share))
    held = held.select("sig", "n", "label", "rank", "kind", F.xxhash64("main.kind", F.floor(F.log(F.col("n")) / float(np.log(100 / SIMILAR)))).alias("family"))
    # Sets with the same main kind and about the same size are the blocks that are asked. The main kind is that with
    # most postings, so many copies with edits of their own, whose kinds are single shingles, share few full blocks;
    # by the largest kind each few of them had a block, and each asked nearly all of these by each of its kinds.
    families = held.select("sig", "n", "family").distinct().groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") * 8 / block_bytes)).cast("long").alias("blocks"))
    held = written(held.join(families, "family").withColumn("block", F.xxhash64(
        "family", F.pmod(F.xxhash64("sig"), "blocks"))).drop("family", "blocks"), "held")
    # Of two labels the one with fewer sets asks, so a large group is asked by its few neighbours and not the other way.
    kind_blocks = held.groupBy("kind", "block").agg(F.max("rank").alias("other"), F.min("n").alias("least"), F.max("n").alias("most"))
    asked = written(held.select("kind", "sig", "label", "rank", "n").join(kind_blocks, "kind").where(
        (F.col("rank") < F.col("other")) & (F.col("most") * 100 >= F.col("n") * SIMILAR)
        & (F.col("least") * SIMILAR <= F.col("n") * 100)).select("block", "sig", "label", "n").distinct(), "asked")
    load = asked.groupBy("block").agg(F.ceil(F.count("*") / QUERIES_AT_ONCE).alias("chunks"))
    queries = asked.join(load, "block").select(
        "block", "sig", "label", F.pmod(F.xxhash64("sig"), "chunks").cast("int").alias("chunk"), F.lit(True).alias("asks"))
    opened = held.select("block", "sig", "label").distinct().join(load, "block").select(
        "block", "sig", "label", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))).alias("chunk"),
        F.lit(False).alias("asks"))
    moved = asked.agg(F.sum("n") * 8).first()[0] or 0
    second = queries.union(opened).join(own_sets, "sig").withColumn("block", F.xxhash64("block", "chunk")).withColumn(
        "cell", F.pmod("block", F.lit(parts_for(moved + 1, CELL_BYTES // 2))))
    links = second.groupBy("cell").applyInArrow(
        tidy_group(lambda t: _each_block(t, _query_block, ["a", "b"], [pa.int64(), pa.int64()])), "a long, b long")
    roots = components(links)
    final = labels.join(roots, labels["label"] == roots["key"], "left").select(
        labels["sig"], F.coalesce("root", "label").alias("component"))
    return sets.drop("prefix", "text_hash").join(final, "sig", "left").withColumn("component", F.coalesce("component", "sig")).drop("sig")


def join_components(docs: DataFrame) -> DataFrame:
    return similar_components(docs).withColumnRenamed("key", "doc_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each connected group: that with the smallest key, a null key being the largest.

    Of rows that repeat this key a fingerprint of the whole row decides, of rows that are equal throughout
    any one stays. Documents without shingles all stay.
    """
    row = [F.xxhash64(*docs.columns).alias("__h1"), F.xxhash64(F.lit(1), *docs.columns).alias("__h2")]
    found = _component_rows(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *row))
    least = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "__h1", "__h2")).alias("least")
    kept = found.where("n > 0").groupBy("component").agg(least).select("least.__h1", "least.__h2", F.lit(True).alias("__one")).union(
        found.where("n = 0").select("__h1", "__h2", F.lit(False)).distinct())
    rows = docs.select("*", *row).join(kept, ["__h1", "__h2"])
    # Equal rows of a group come down to one; all others differ by the number.
    once = rows.withColumn("__nth", F.when(F.col("__one"), F.lit(-1)).otherwise(F.monotonically_increasing_id()))
    return once.dropDuplicates(["__h1", "__h2", "__nth"]).select(docs.columns)
