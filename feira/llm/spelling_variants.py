"""Spelling variants: words one edit apart, found by edits that Bloom filters let through.

1. The vocabulary is counted over whole texts, with sums per task before the shuffle.
2. Its words go into blocked Bloom filters (blocks of 512 bits, 16 bits a word), one for each length and share
   of ``WORDS_PER_FILTER`` words, so that a frequent length has several. Filters are broadcast at most
   ``FILTER_BYTES`` at a time; a larger vocabulary takes more passes over its words.
3. Each word generates its deletions and its replacements by later letters and asks the filter of the resulting
   length. Every pair of near words is generated from exactly one side by exactly one edit: of equal letters in
   a row only the first is deleted, and insertions are deletions seen from the other word. Edits are rolling
   hashes until a filter lets them through, so long words cost no copies; a length without other words is skipped.
4. Only what a filter lets through is shuffled, as (hash, place, letter), and joined with the vocabulary by
   length and hash. The join then compares the edited word letter by letter, so filters and hashes decide
   nothing.
5. A word's form is its most frequent near word, if that is at least twice as frequent. Frequencies double
   along forms, so chains have at most 63 steps; roots are found by pointer doubling.

Null or empty texts have no words, whatever their length; a null id counts as an empty one where ids matter.
Repeated rows count again. Ties go to the smaller word in code-point order. An empty table has no words. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, tidy, tidy_group
from feira.session import scratch_path

LETTERS = bytes([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]).decode("latin-1")
SHORTEST = 5
RAREST = 3
WORDS_PER_FILTER = 1 << 19
FILTER_BYTES = 32 << 20
BITS_PER_WORD = 16
BLOCK_BITS = 512
PROBES = 7  # bits of a block that belong to a word
COUNTED_AT_ONCE = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)

# Latin-1 bytes with A-Z in lower case and everything that is no letter as a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if chr(b) in LETTERS else 32 for b in range(256))


def _damaged(word: bytes, key: int, every: int) -> bytes:
    """The word, or for one key of ``every`` the word without one letter."""
    value = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), key)
    if value % every:
        return word
    at = value % len(word)
    return word[:at] + word[at + 1:]


def _counted(every: int, shortest: int):
    """Partial counts (word, n) of the words in batches of (id, text)."""
    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def each(batches):
        total: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                key = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(text.encode("latin-1", "replace").translate(_FOLD).split(b" ")).items():
                    if len(word) >= shortest:
                        word = _damaged(word, key, every) if every else word
                        if len(word) >= shortest:
                            total[word] += n
                if len(total) >= COUNTED_AT_ONCE:
                    yield table(total)
                    total = Counter()
        yield table(total)

    return each


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", damaged_every: int = 0,
                shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n): runs of letters in lower case with at least ``shortest`` letters and ``rarest`` occurrences.

    With ``damaged_every`` one run of so many, chosen by id and run, first loses a letter, as planted misspellings.
    """
    bounded_batches(docs.sparkSession)
    parts = docs.select(F.col(key).cast("string"), text).mapInArrow(tidy(_counted(damaged_every, shortest)), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(words: list[str]) -> np.ndarray:
    """Code points of equally long words, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _powers(count: int) -> np.ndarray:
    """The first powers of the base, modulo 2^64."""
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(count, BASE), dtype=np.uint64)))


def _hashes(letters: np.ndarray) -> np.ndarray:
    size = letters.shape[1]
    return (letters * _powers(size)[size - 1::-1][:size]).sum(axis=1, dtype=np.uint64)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        groups.setdefault(len(word), []).append(k)
    return groups


def _keyed(batches):
    """Adds length and hash to (word, n)."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        found = np.zeros(len(words), np.uint64)
        for at in _by_length(words).values():
            found[at] = _hashes(_letters([words[k] for k in at]))
        sizes = pa.array([len(w) for w in words], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, sizes, pa.array(found.view(np.int64)), pa.array(_mixed(found).view(np.int64))],
            names=["word", "n", "size", "hash", "spot"])


def _bits(spots: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of the block of each spot, and a number whose groups of nine bits choose bits in it."""
    block = (_mixed(spots ^ BASE) % np.uint64(blocks)) * np.uint64(BLOCK_BITS // 64)
    return block.astype(np.int64), _mixed(spots + BASE)


def make_filter(spots: np.ndarray) -> np.ndarray:
    """The blocked Bloom filter of the spots."""
    blocks = max(1, -(-len(spots) * BITS_PER_WORD // BLOCK_BITS))
    bits = np.zeros(blocks * BLOCK_BITS // 64, np.uint64)
    start, choice = _bits(spots, blocks)
    for j in range(PROBES):
        at = (choice >> np.uint64(9 * j)) & np.uint64(BLOCK_BITS - 1)
        np.bitwise_or.at(bits, start + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return bits


def passing(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Places of the spots that the filter lets through."""
    alive = np.arange(len(spots))
    start, choice = _bits(spots, len(bits) * 64 // BLOCK_BITS)
    for j in range(PROBES):
        at = (choice >> np.uint64(9 * j)) & np.uint64(BLOCK_BITS - 1)
        held = (bits[start + (at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        alive, start, choice = alive[held], start[held], choice[held]
    return alive


def _filter_of(table: pa.Table) -> pa.Table:
    """The filter of one share of a length."""
    bits = make_filter(table.column("spot").to_numpy().view(np.uint64))
    first = [table.column(c)[:1].combine_chunks() for c in ("size", "share", "shares", "words")]
    return pa.Table.from_arrays([*first, pa.array([bits.tobytes()], pa.binary())], names=["size", "share", "shares", "words", "bits"])


def _probed(filters, letters: str):
    """Edits of the words in batches of (word, size, hash) that the broadcast filters let through."""
    alphabet = _letters(list(letters))[:, 0]

    def asked(held: dict, size: int, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that a filter of this length knows."""
        spots, known = _mixed(hashes), held.get(size)
        if known is None:
            return np.zeros(0, np.int64)
        shares, _, parts = known
        if shares == 1:
            return passing(parts[0], spots)
        share = np.mod(spots.view(np.int64), shares)
        found = []
        for k, bits in parts.items():
            at = np.flatnonzero(share == k)
            found.append(at[passing(bits, spots[at])])
        return np.concatenate(found)

    def edits(held: dict, words: list[str], own: np.ndarray, size: int):
        """(hashes of the words, place, letters, size, hashes) place by place."""
        code, power = _letters(words), _powers(size)
        shorter, equal = size - 1 in held, size in held and held[size][1] > 1
        before = np.zeros(len(words), np.uint64)
        behind = own.copy()
        for i in range(size):
            column, weight = code[:, i], power[size - 1 - i]
            behind = behind - column * weight
            if shorter:
                new = np.flatnonzero(column != code[:, i - 1]) if i else np.arange(len(words))
                made = (before * weight + behind)[new]
                at = asked(held, size - 1, made)
                yield own[new[at]], i, [""] * len(at), size - 1, made[at]
            if equal:
                word, letter = np.nonzero(alphabet[None, :] > column[:, None])
                made = own[word] + (alphabet[letter] - column[word]) * weight
                at = asked(held, size, made)
                yield own[word[at]], i, [letters[k] for k in letter[at]], size, made[at]
            before = before * BASE + column

    def each(batches):
        held: dict = {}
        for size, share, shares, words, bits in filters.value:
            held.setdefault(size, (shares, words, {}))[2][share] = np.frombuffer(bits, np.uint64)
        for batch in batches:
            words, hashes = batch.column(0).to_pylist(), batch.column(2).to_numpy().view(np.uint64)
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for size, at in _by_length(words).items():
                for own, place, letter, length, made in edits(held, [words[k] for k in at], hashes[at], size):
                    if len(own):
                        for column, value in zip(out, ([size] * len(own), own.view(np.int64), [place] * len(own), letter,
                                                       [length] * len(own), made.view(np.int64))):
                            column.extend(value)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=EDIT_COLUMNS)

    return each


EDIT_COLUMNS = ["size", "hash", "place", "letter", "near_size", "near_hash"]
EDIT_SCHEMA = "size int, hash long, place int, letter string, near_size int, near_hash long"


def _passes(sizes: list, limit: int) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """First and last (length, share) of runs of filters that together stay within ``limit`` bytes."""
    runs: list[list] = []
    for size, share, n_bytes in sorted(sizes):
        if runs and runs[-1][2] + n_bytes <= limit:
            runs[-1][1:] = [(size, share), runs[-1][2] + n_bytes]
        else:
            runs.append([(size, share), (size, share), n_bytes])
    return [(first, last) for first, last, _ in runs]


def near_pairs(vocabulary: DataFrame, letters: str) -> DataFrame:
    """(word, n, near, near_n), each pair once, of a written vocabulary with sizes, hashes and spots."""
    spark = vocabulary.sparkSession
    lengths = vocabulary.groupBy("size").agg(F.count("*").alias("words"))
    shares = lengths.withColumn("shares", F.ceil(F.col("words") / WORDS_PER_FILTER).cast("int"))
    placed = vocabulary.select("size", "spot").join(shares, "size").withColumn("share", F.pmod("spot", "shares").cast("int"))
    # Dealt by both, or the join's partitions by length alone would be taken for the groups.
    filters = written(placed.repartition("size", "share").groupBy("size", "share").applyInArrow(
        tidy_group(_filter_of), "size int, share int, shares int, words long, bits binary"), "filters")
    path = scratch_path(spark, "edits")
    rows = [tuple(r) for r in filters.select("size", "share", F.octet_length("bits")).collect()]  # a row per half million words or length
    spark.createDataFrame([], EDIT_SCHEMA).write.parquet(f"{path}/turn=-1")
    for k, (first, last) in enumerate(_passes(rows, FILTER_BYTES)):
        place = F.struct("size", "share")
        chosen = filters.where((place >= F.struct(F.lit(first[0]), F.lit(first[1]))) & (place <= F.struct(F.lit(last[0]), F.lit(last[1]))))
        held = spark.sparkContext.broadcast([tuple(r) for r in chosen.select("size", "share", "shares", "words", "bits").collect()])
        asking = vocabulary.select("word", "size", "hash").where(F.col("size").between(first[0], last[0] + 1))
        asking.mapInArrow(tidy(_probed(held, letters)), EDIT_SCHEMA).write.parquet(f"{path}/turn={k}")
        held.destroy()
    edits = spark.read.parquet(path).drop("turn")
    near = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("size").alias("near_size"), F.col("hash").alias("near_hash"))
    pairs = edits.join(near, ["near_size", "near_hash"]).join(vocabulary.drop("spot"), ["size", "hash"])
    edited = F.expr("concat(left(word, place), letter, substring(word, place + 2))")
    return pairs.where(edited == F.col("near")).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form, by pointer doubling; forms must not lead back."""
    known = forms.select(F.col("word").alias("root"), F.lit(True).alias("more"))
    step = written(forms.select("word", F.col("form").alias("root")).join(known, "root", "left").select(
        "word", "root", F.coalesce("more", F.lit(False)).alias("more")), "roots")
    while not step.where("more").isEmpty():
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("more").alias("next_more"))
        moved = step.where("more").join(ahead, "root").select("word", F.col("next").alias("root"), F.col("next_more").alias("more"))
        step = written(step.where("NOT more").union(moved), "roots")
    return step.drop("more")


def variants(words: DataFrame, letters: str = LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n for (word, n), whose words are distinct and of ``letters``."""
    bounded_batches(words.sparkSession)
    vocabulary = written(words.select("word", "n").mapInArrow(tidy(_keyed), "word string, n long, size int, hash long, spot long"), "vocabulary")
    pairs = near_pairs(vocabulary, letters)
    links = pairs.union(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    found = links.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    judged = written(vocabulary.select("word", "n").join(found, "word", "left").withColumn(
        "form", F.when(-F.col("best.n") >= 2 * F.col("n"), F.col("best.near"))), "forms")
    ends = roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), -F.col("best.n")).alias("form_n"))
