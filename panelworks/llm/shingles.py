"""Word shingles of documents as 64-bit hashes, computed for a whole Arrow slice at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from panelworks.llm.common import FACTOR, mix, utf8, word_table

WIDTH = 5


def distinct_shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text and where each text's shingles start.

    A-Z is lower-cased; words are separated by ASCII white space.  A text with fewer words
    than ``width`` has its whole sequence as one shingle, a text without words has none.
    Within a text, hashes ascend.
    """
    _, base, sizes, begin, _, hashes = word_table(utf8(texts))
    hashes = mix(hashes)
    counts = np.searchsorted(begin, base + sizes) - np.searchsorted(begin, base)
    ends = np.cumsum(counts)
    full = np.maximum(counts - width + 1, 0)
    # first word of each full shingle: the document's first word plus the place in it
    doc = np.repeat(np.arange(len(counts)), full)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
    first = (ends - counts)[doc] + place
    value = np.zeros(len(first), np.uint64)
    for k in range(width):
        value = value * FACTOR + hashes[first + k]
    value = mix(value)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if short.size:
        whole = counts[short].astype(np.uint64)  # sequences of other lengths differ
        for k in range(width - 1):
            longer = counts[short] > k
            at = (ends - counts)[short][longer] + k
            whole[longer] = whole[longer] * FACTOR + hashes[at]
        whole = mix(mix(whole))
        doc, value = np.concatenate([doc, short]), np.concatenate([value, whole])
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    parts = []
    sizes = np.zeros(len(counts), np.int64)
    bounds = np.searchsorted(doc, np.arange(len(counts) + 1))
    for i in np.flatnonzero(np.diff(bounds)):
        own = np.sort(value[bounds[i] : bounds[i + 1]])
        new = np.empty(len(own), bool)
        new[0] = True
        np.not_equal(own[1:], own[:-1], out=new[1:])
        if not new.all():
            own = own[new]
        sizes[i] = len(own)
        parts.append(own)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), starts


def set_keys(shingles: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit key of each set as two int64 arrays: sums of two mixings of its elements."""
    keys = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(salt)))])
        keys.append((upto[starts[1:]] - upto[starts[:-1]]).view(np.int64))
    return keys[0], keys[1]
