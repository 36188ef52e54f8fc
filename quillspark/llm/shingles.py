"""Sets of word shingles as sorted 64-bit hashes, for whole batches of texts."""

from __future__ import annotations

import numpy as np

from quillspark.llm.common import BYTE_CODES, LOWER, mix, prefix_hashes, substring_hashes, word_spans

_STEP = np.uint64(0xD1342543DE82EF95)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted within it, and where each text's begin (with a last end).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A text of fewer words, but not none,
    has its whole sequence as its one shingle.
    """
    low = LOWER[data]
    starts, stops = word_spans(low, offsets)
    hashes = mix(substring_hashes(prefix_hashes(BYTE_CODES[low]), starts, stops))
    edges = np.searchsorted(starts, offsets)
    counts = np.diff(edges)
    rolled = np.zeros(len(hashes), np.uint64)
    for j in range(min(words, len(hashes))):
        rolled[: len(hashes) - j] = rolled[: len(hashes) - j] * _STEP + hashes[j:]
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - edges[:-1][owner]
    whole = place <= counts[owner] - words
    for d in np.flatnonzero((counts > 0) & (counts < words)):
        value = int(counts[d])
        for h in hashes[edges[d] : edges[d + 1]].tolist():
            value = (value * int(_STEP) + h) % 2**64
        rolled[edges[d]], whole[edges[d]] = value, True
    rolled, owner = mix(rolled[whole]), owner[whole]
    order = np.lexsort((rolled, owner))
    rolled, owner = rolled[order], owner[order]
    first = np.ones(len(rolled), bool)
    first[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    rolled, owner = rolled[first], owner[first]
    return rolled, np.searchsorted(owner, np.arange(len(counts) + 1))
