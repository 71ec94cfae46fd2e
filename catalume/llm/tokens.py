"""Token ids of whole texts, by the tokenizers library, inside Arrow batches.

A byte-level BPE encodes each piece of its split pattern alone, and a single blank between two characters that
are no white space always begins a piece. So a text is the sequence of its blank-separated chunks, and a chunk
met before need not be encoded again: each Python worker keeps the ids of up to twice CACHE_ENTRIES chunks. Chunks
that end in punctuation are the ids of what stands before and those of the punctuation, a piece of its own; chunks
that begin or end with white space make a text be cut at such blanks alone, so the ids are those of the whole text.
"""

from __future__ import annotations

import array
import os
import re
import string

import numpy as np

CACHE_ENTRIES = 500_000
CACHE_BYTES = 34_000_000

_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_EDGED = re.compile(r" (?:\s|\Z|(?<=\s\s)|(?<=\A ))")
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts as bytes of native unsigned 16- or 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.code = "H" if max(vocabulary.values()) < 1 << 16 else "I"
        self.dtype = np.dtype(np.uint16 if self.code == "H" else np.uint32)
        self.leading = np.zeros(max(vocabulary.values()) + 1, bool)
        self.leading[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.size = 0

    def alone(self, texts: list[str]) -> list[bytes]:
        return [array.array(self.code, x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of blank + chunk for each chunk; those without a blank are encoded as one text and cut where a token holds one."""
        plain = [x for x in chunks if " " not in x and not edged(x)]
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(plain)], add_special_tokens=False)[0].ids if plain else [], self.dtype)
        starts = np.flatnonzero(self.leading[ids])
        found = {}
        if len(starts) == len(plain):
            raw, at = ids.tobytes(), (starts * self.dtype.itemsize).tolist()
            found = {chunk: raw[a:b] for chunk, a, b in zip(plain, at, [*at[1:], len(raw)])}
        rest = [x for x in chunks if x not in found]
        return found | dict(zip(rest, self.alone([" " + x for x in rest])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """texts: without None."""
        known, older = self.known, self.older
        chunks = [_SAFE_BLANK.split(x) if _EDGED.search(x) else x.split(" ") for x in texts]
        heads = self.alone([x[0] for x in chunks])
        for x in chunks:
            del x[0]
        new = set().union(*chunks).difference(known)
        found = {x: older[x] for x in new if x in older}
        stems = {x: y for x in new.difference(found) if (y := stem(x)) != x}
        needed = new.difference(found, stems).union(y for y in stems.values() if y not in known)
        found.update((x, older[x]) for x in needed if x in older)
        found.update(self.learn(list(needed.difference(found))))
        tails = {x[len(y) :] for x, y in stems.items()}.difference(self.tails)
        self.tails.update(zip(tails, self.alone(list(tails))))
        for x, y in stems.items():
            found[x] = (known.get(y) or found[y]) + self.tails[x[len(y) :]]
        if len(self.tails) > 10_000:
            self.tails = {}
        self.size += sum(map(len, found)) + sum(map(len, found.values()))
        known.update(found)
        out = [head + b"".join(map(known.__getitem__, x)) for head, x in zip(heads, chunks)]
        if len(known) > CACHE_ENTRIES or self.size > CACHE_BYTES:
            self.older, self.known, self.size = known, {}, 0
        return out


def stem(chunk: str) -> str:
    """chunk without the ASCII punctuation at its end, if a letter or number stands before it."""
    short = chunk.rstrip(string.punctuation)
    return short if short and short[-1].isalnum() and "<|" not in chunk else chunk


def edged(chunk: str) -> bool:
    """Whether white space, or nothing, meets the blanks around chunk."""
    return not chunk or chunk[0].isspace() or chunk[-1].isspace()


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(texts, path: str, end_id: int, rows: int = 256):
    """For each text (of a list or an Arrow column), in order: an array of unsigned 32-bit little-endian ids with end_id behind them."""
    made = encoder(path)
    for i in range(0, len(texts), rows):
        some = texts[i : i + rows]
        for raw in made.encode([x or "" for x in (some if isinstance(some, list) else some.to_pylist())]):
            ids = np.empty(len(raw) // made.dtype.itemsize + 1, "<u4")
            ids[:-1] = np.frombuffer(raw, made.dtype)
            ids[-1] = end_id
            yield ids
