"""Sets of word shingles as sorted arrays of 64-bit hashes, for a batch of texts at a time.

Words are runs of other bytes than white space (0x20, 0x09-0x0D), A-Z in lower case. A set holds the distinct shingles of WIDTH words;
a text of fewer words has its whole sequence as the only one; no words, no shingles.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

WIDTH = 5
SLICE = 1 << 20  # bytes of text worked on at once, one text at least


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64 bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


BYTES, PLACES = keys(256, 1), keys(WIDTH, 2)


def of_bytes(data: np.ndarray, cuts: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The set of each text data[cuts[i]:cuts[i + 1]]."""
    global BYTES
    none = np.zeros(0, np.uint64)
    low = np.where((data >= 65) & (data <= 90), data | 32, data)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    inside = np.flatnonzero(~space)
    if not len(inside):
        return [none] * (len(cuts) - 1)
    fresh = np.zeros(len(low) + 1, bool)
    fresh[1:-1] = space[:-1]
    fresh[cuts] = True
    first = np.flatnonzero(fresh[inside])
    lengths = np.diff(np.append(first, len(inside)))
    if lengths.max() > len(BYTES):
        BYTES = keys(int(lengths.max()), 1)
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    words = mix(np.add.reduceat((low[inside].astype(np.uint64) + np.uint64(1)) * BYTES[place], first) + lengths.astype(np.uint64))
    text = np.searchsorted(cuts, inside[first], "right") - 1
    per_text = np.bincount(text, minlength=len(cuts) - 1)
    ends = np.cumsum(per_text)
    rows = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rows += words[k : k + len(rows)] * PLACES[k]
    rows = mix(rows)
    out = []
    for end, n in zip(ends.tolist(), per_text.tolist()):
        if n >= width:
            found = np.sort(rows[end - n : end - width + 1])
            out.append(found[np.append(True, found[1:] != found[:-1])])
        elif n:
            out.append(mix(np.array([int((words[end - n : end] * PLACES[:n]).sum()) + n & (1 << 64) - 1], np.uint64)))
        else:
            out.append(none)
    return out


def of_column(texts: pa.Array):
    """The set of each text of an Arrow column of strings, in order; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + SLICE, "right")) - 1)
        yield from of_bytes(raw[cuts[at] : cuts[to]], cuts[at : to + 1] - cuts[at])
        at = to


def fingerprint(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
