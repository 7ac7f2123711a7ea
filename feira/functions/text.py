"""Text matching: trigram similarity, tokens and term scores."""

from __future__ import annotations

import re
import unicodedata
from functools import cache
from collections.abc import Callable

from pyspark.sql import Column, functions as F

NON_WORD = r"[^\p{L}\p{N}]+"


SEPARATOR = "\u0001"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def padded_words(text: Column) -> Column:
    """All words in one string, each with two blanks before and one after, and a separator between.

    Every three characters without the separator are then a trigram of one word.
    """
    bare = F.regexp_replace(F.lower(text), rf"^{NON_WORD}|{NON_WORD}$", "")
    spaced = F.regexp_replace(bare, NON_WORD, f" {SEPARATOR}  ")
    return F.when(F.length(bare) == 0, F.lit("")).otherwise(F.concat(F.lit("  "), spaced, F.lit(" ")))


def padded_trigrams(padded: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(padded, F.lit(f"(?=([^{SEPARATOR}]{{3}}))"), F.lit(1)))


def trigrams(text: Column) -> Column:
    """Distinct trigrams of all words of a text."""
    return padded_trigrams(let(text, padded_words))


def literal_trigrams(text: str) -> list[str]:
    """Trigrams of a search text, known while the plan is built."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return sorted({f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)})


def similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams, 0 to 1; NULL if a text is NULL."""
    def ratio(pair: Column) -> Column:
        shared = F.size(F.array_intersect(pair["a"], pair["b"])).cast("double")
        united = F.size(pair["a"]) + F.size(pair["b"]) - shared
        return F.when(united == 0, F.lit(0.0)).otherwise(shared / F.nullif(united, F.lit(0.0)))

    pair = F.struct(trigrams(a).alias("a"), trigrams(b).alias("b"))
    return F.when(a.isNotNull() & b.isNotNull(), let(pair, ratio))


def similar_enough(text: Column, wanted: str, threshold: float, inclusive: bool = False) -> Column:
    """Array with the similarity of a text to a search text if it passes the threshold, else empty.

    Each wanted trigram is looked for in the text first. The share of them that occurs is never
    below the similarity, so only texts where it passes have their own trigrams counted.
    """
    grams = literal_trigrams(wanted)

    def passes(value: Column) -> Column:
        return value >= threshold if inclusive else value > threshold

    def shared(padded: Column) -> Column:
        return sum((F.contains(padded, F.lit(g)).cast("int") for g in grams), F.lit(0)).cast("double")

    def score(found: Column) -> Column:
        united = F.size(padded_trigrams(found["padded"])).cast("double") + float(len(grams)) - found["hits"]
        return let(united, lambda n: F.when(n > 0, found["hits"] / F.nullif(n, F.lit(0.0))).otherwise(F.lit(0.0)))

    counted = F.transform(F.array(padded_words(text)), lambda p: F.struct(p.alias("padded"), shared(p).alias("hits")))
    candidates = F.filter(counted, lambda found: passes(found["hits"] / float(max(len(grams), 1))))
    return F.filter(F.transform(candidates, score), passes)


def tokens(text: Column) -> Column:
    """Lower-case words of a text in order, with repeats."""
    return F.filter(F.split(F.lower(text), NON_WORD), lambda w: w != "")


def word_pattern(terms: list[str]) -> str:
    """Regular expression for any of the words, whole and in lower case."""
    words = "|".join(re.escape(t) for t in sorted(terms))
    return rf"(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"


def term_share(text: Column, terms: list[str]) -> Column:
    """Share of the words of a text that are one of ``terms``; 0 for a text without words.

    Counts matches instead of building the list of words, which for long texts is most of the work.
    """
    hits = F.regexp_count(F.lower(text), F.lit(word_pattern(terms))).cast("double")
    words = F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+")).cast("double")
    return F.when(words > 0, hits / words).otherwise(F.lit(0.0))


WORD = r"[\p{L}\p{M}\p{N}]"


def folded_words(text: str) -> list[str]:
    """The words of a search text in lower case and without accents."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    return re.findall(r"[^\W_]+", plain)


@cache
def _accented() -> dict[str, str]:
    """Latin letters by the letter they have without accents, as Unicode decomposes them."""
    found: dict[str, str] = {}
    for letter in map(chr, range(0xC0, 0x250)):
        base, *marks = unicodedata.normalize("NFD", letter)
        if marks and all(unicodedata.combining(m) for m in marks) and letter == letter.lower():
            found[base] = found.get(base, "") + letter
    return found


def folded_pattern(word: str) -> str:
    """Regular expression for a whole word in lower case, with any accents, composed or not."""
    letters = "".join(f"[{c}{_accented().get(c, '')}]\\p{{M}}*" for c in word)
    return rf"(?<!{WORD}){letters}(?!{WORD})"
