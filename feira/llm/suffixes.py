"""Suffix order by prefix doubling, in numpy, for the text of one task."""

from __future__ import annotations

import numpy as np


def suffix_order(keys: np.ndarray, depth: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes and the row of each.

    ``keys`` sort the suffixes by their first ``depth`` symbols. The text must hold symbols that occur
    once (separators), so that no suffix is a prefix of another. Only rows still tied are sorted again.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    heads = np.concatenate(([True], ranked[1:] != ranked[:-1])) if n else np.zeros(0, bool)
    row = np.empty(n, np.int64)
    row[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    while n:
        tied = np.flatnonzero(~(heads & np.append(heads[1:], True)))
        if not len(tied):
            break
        at = order[tied]
        after = at + depth
        second = np.where(after < n, row[np.minimum(after, n - 1)] + 1, 0)
        key = row[at] * (n + 1) + second
        by = np.argsort(key)
        at, key = at[by], key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        order[tied], heads[tied] = at, new
        row[at] = np.maximum.accumulate(np.where(new, tied, 0))
        depth *= 2
    return order, row
