"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

PIECE_BYTES = 1 << 22
#: Most different words whose hashes a task keeps.
CACHE = 1 << 18


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def word_hashes(text: bytes, known: WordHashes) -> np.ndarray:
    """Hashes of the words of a UTF-8 text, lower-cased in ASCII and split at space and U+0009 to U+000D."""
    if len(text) <= PIECE_BYTES:
        found = text.lower().split()
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + PIECE_BYTES)
        while end < len(text) and not text[end : end + 1].isspace():  # not inside a word
            end += 1
        parts.append(word_hashes(text[at:end], known) if end - at <= PIECE_BYTES else np.fromiter(map(known.__getitem__, text[at:end].lower().split()), np.uint64))
        at = end
    return np.concatenate(parts)


def _mix(words: np.ndarray, starts: int, width: int) -> np.ndarray:
    out = np.full(starts, width, np.uint64)
    for k in range(width):
        out = (out ^ words[k : k + starts]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def shingle_sets(texts: list[bytes], width: int, known: WordHashes, block: int = 1 << 22) -> Iterator[np.ndarray]:
    """For every text the sorted different hashes of its ``width``-word shingles; of all words if there are fewer."""
    at = 0
    while at < len(texts):
        held, size = [], 0
        while at < len(texts) and (not held or size + len(texts[at]) <= block):
            held.append(word_hashes(texts[at], known))
            size += len(texts[at])
            at += 1
        line = np.concatenate(held)
        mixed = _mix(line, max(0, len(line) - width + 1), width)
        begin = 0
        for words in held:
            n = len(words)
            if n >= width:
                yield np.unique(mixed[begin : begin + n - width + 1])
            else:
                yield _mix(words, 1, n) if n else words
            begin += n
