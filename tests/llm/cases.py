"""Small documents with every awkward case, and brute-force versions of the text operators."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(words))


def documents(seed=7):
    """Near and exact copies, shared passages, nulls, empty, very long and periodic texts, a repeated row."""
    rng = random.Random(seed)
    base = [sentence(rng, 120) for _ in range(6)]
    passage = sentence(rng, 90)
    texts = list(base)
    for b in base[:3]:
        words = b.split()
        for _ in range(4):
            changed = list(words)
            changed[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(changed))
        texts.append(b)
    texts += [sentence(rng, 60) + " " + passage + " " + sentence(rng, 60) for _ in range(5)]
    texts += [passage[:450] + "é" + passage[450:], "ab " * 900, "x" * 1300, "", None, "   ", "one two three", "ONE two  three", "12 34 ++"]
    texts.append(" ".join(sentence(rng, 200) for _ in range(20)) + " " + passage)
    rows = [(k, t, "en" if k % 2 else "de", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return [*rows, rows[0], (None, base[1], None, None, None)]


def repeated(texts, length):
    """Spans that strings of ``length`` bytes with another occurrence cover, per text."""
    seen = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k:k + length]] = seen.get(t[k:k + length], 0) + 1
    out = []
    for t in texts:
        spans = []
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + length
                else:
                    spans.append([k, k + length])
        out.append(spans)
    return out


def without(data, spans):
    at, kept = 0, b""
    for a, b in spans:
        kept, at = kept + data[at:a], b
    return kept + data[at:]


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def one_of_each(rows):
    """(id, text) of the row with the smallest id of each component, and all rows without shingles; a group's
    smallest id must not be repeated with another text."""
    places = similar_components([(k, t) for k, (_, t) in enumerate(rows)])
    least = {}
    for (k, n, c), (doc, text) in zip(places, rows):
        if n and ((doc is None, doc or 0) < least.get(c, ((True, 1), None))[0]):
            least[c] = ((doc is None, doc or 0), (doc, text))
    return [v for _, v in least.values()] + [row for (_, n, _), row in zip(places, rows) if not n]


def similar_components(rows):
    """Smallest id of each row's component, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return [(doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(docs, items):
    """(doc, n_words, n_hit, n_items, digest, contaminated) by trying every window at every word."""
    windows = {}
    for item, text in items:
        w = bench_words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)
