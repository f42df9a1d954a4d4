"""Words found, packed and hashed on the bytes of an Arrow column: for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from gleanwork.llm.common import SPACES
from gleanwork.llm.shingles import mix

NO_SPACE = np.ones(256, bool)
NO_SPACE[list(SPACES.encode())] = False
#: A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column without nulls."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int):
    """Ranges of rows with about ``most`` bytes; a longer row is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = min(rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1))
        yield row, end
        row = end


def find_runs(member: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of bytes of ``member``; text i is ``data[offsets[i]:offsets[i + 1]]``."""
    inside = member[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    before[borders] = False
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1 - starts


def _first_bytes(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The first ``left`` (0 to 8) bytes of big-endian words, zeros after them."""
    # A shift by 64 is not defined, so everything is shifted in two steps.
    half = (4 * (8 - left)).astype(np.uint64)
    return (((words >> half) >> half) << half) << half


def pack(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """The bytes of runs of at most ``8 * words`` bytes as that many 64-bit words, padded with zeros."""
    padded = np.concatenate([data, np.zeros(8 * words + 8, np.uint8)])
    at_each = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    return [
        _first_bytes(at_each[starts + 8 * i].astype(np.uint64), np.clip(lengths - 8 * i, 0, 8)) for i in range(words)
    ]


def hash_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    at_each = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    hashes = lengths.astype(np.uint64)
    step, active = 0, np.arange(len(starts))
    while len(active):
        word = _first_bytes(at_each[starts[active] + step].astype(np.uint64), np.minimum(lengths[active] - step, 8))
        hashes[active] = mix(hashes[active] * np.uint64(0x9E3779B97F4A7C15) + word)
        step += 8
        active = active[lengths[active] > step]
    return hashes


def text_blocks(column: pa.Array, member: np.ndarray, most: int):
    """``(first row, whether the last text ends here, data, offsets)`` of about ``most`` bytes each.

    A longer text is cut where a run of ``member`` ends, so that a block stays bounded but for one run.
    """
    data, offsets = text_bytes(column)
    for row, end in slices(offsets, most):
        at, stop = int(offsets[row]), int(offsets[end])
        if end - row > 1 or stop - at <= most:
            yield row, True, data[at:stop], offsets[row : end + 1] - at
            continue
        while at < stop:
            cut, look = min(at + most, stop), most
            while cut < stop:
                breaks = np.flatnonzero(~member[data[cut : min(cut + look, stop)]])
                if len(breaks):
                    cut += int(breaks[0])
                    break
                cut = min(cut + look, stop)
            yield row, cut == stop, data[at:cut], np.asarray([0, cut - at])
            at = cut
