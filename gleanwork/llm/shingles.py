"""Word shingles and MinHash in numpy: for use inside tasks."""

from __future__ import annotations

import math

import numpy as np

from gleanwork.llm.common import lower_ascii, split_words, worker_state

WIDTH = 5
#: Words whose hash a worker remembers before it starts anew.
CACHE = 400_000
STEP = 4096


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes() -> WordHashes:
    return worker_state().setdefault("word hashes", WordHashes())


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` hashed words."""
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - width + 1 + i]
    return mix(total)


def shingles(text: str, hashes: WordHashes, width: int = WIDTH, lead: bool = False) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``width`` words, A-Z in lower case.

    A text of fewer words has one shingle, all its words; one without words has none. With ``lead`` the
    runs start before the text, so that there is one for each word, however short the text is.
    """
    words = split_words(lower_ascii(text))
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if lead:
        values = np.concatenate([np.zeros(width - 1, np.uint64), values])
    return np.unique(windows(values, min(width, len(values))))


def permutations(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``count`` universal hash functions."""
    draw = np.random.default_rng(seed).integers(0, 2**63, size=(2, count), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def minhash(values: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least value of every hash function, 32 bits each; all ones for no shingles."""
    least = np.full(len(factors), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(values), STEP):
        part = values[at : at + STEP, None] * factors
        part += offsets
        np.minimum(least, part.min(axis=0) >> np.uint64(32), out=least)
    return least


def choose_bands(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """Bands and rows with the most rows for which pairs at the threshold meet with chance ``recall``."""
    best = None
    for rows in range(1, most_hashes + 1):
        chance = threshold**rows
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - chance))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding of that many hashes reaches the recall")
    return best


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; bands don't share keys."""
    table = signature[: bands * rows].reshape(bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for column in range(rows):
        total = total * np.uint64(0x9E3779B97F4A7C15) + table[:, column]
    return mix(total)
