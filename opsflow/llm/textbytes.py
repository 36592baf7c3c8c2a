"""Text columns as byte arrays: word and shingle hashes for whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; longer texts are handled alone.
SLICE = 1 << 18
U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (two multiply-xorshift steps)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_factors = np.zeros(0, np.uint64)


def factors(n: int) -> np.ndarray:
    """Odd pseudorandom factors by position."""
    global _factors
    if len(_factors) < n:
        size = max(256, 1 << (n - 1).bit_length())
        _factors = mix64(np.arange(1, size + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) | U(1)
    return _factors[:n]


def byte_slices(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``rows, bytes, offsets`` of runs of texts; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    ends = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, "right")) - 1)
        yield slice(first, last), data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lowered, and the row it is in.

    Long texts are handled in stretches that end between words, so memory beyond the
    words themselves is bounded unless a single word is long.
    """
    parts = [(begin, *_words(data[begin:end], offsets, begin)) for begin, end in _stretches(data)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.concatenate([part[1] for part in parts])
    starts = np.concatenate([part[2] + part[0] for part in parts])
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def _space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _stretches(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of stretches of ``SLICE`` bytes, each prolonged to the next space."""
    begin = 0
    while begin < len(data):
        end = begin + 2 * SLICE
        if end < len(data):
            end = begin + SLICE
            while end < len(data):
                spaces = _space(data[end : end + SLICE])
                if spaces.any():
                    end += int(spaces.argmax())
                    break
                end += SLICE
        end = min(end, len(data))
        yield begin, end
        begin = end


def _words(data: np.ndarray, offsets: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a stretch that begins at ``begin``."""
    size = len(data)
    solid = ~_space(data)
    edge = np.zeros(size + 1, bool)
    edge[offsets[(offsets >= begin) & (offsets <= begin + size)] - begin] = True
    before = np.empty(size, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    after = np.empty(size, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    lower = data.astype(np.uint64)
    lower[(data >= 65) & (data <= 90)] += U(32)
    inside = np.arange(size, dtype=np.int64)
    inside -= _start_of(starts, size)
    table = factors(int((ends - starts).max()) + 1)
    terms = (lower + U(1)) * table[np.minimum(inside, len(table) - 1)]
    terms[~solid] = 0
    hashes = mix64(np.add.reduceat(terms, starts) + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    return hashes, starts


def _start_of(starts: np.ndarray, size: int) -> np.ndarray:
    """For every byte the start of the word at or before it (0 before the first)."""
    out = np.zeros(size, np.int64)
    out[starts] = np.diff(starts, prepend=0)
    return np.cumsum(out)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``rows, counts, hashes``: the distinct shingles of each row, ascending.

    A row with fewer words than ``width`` has its whole sequence as one shingle, a
    row without words has none.
    """
    coefficient = factors(64 + width)[64:]
    for rows, data, offsets in byte_slices(column):
        words, row = word_hashes(data, offsets)
        n = len(words)
        texts = len(offsets) - 1
        per_row = np.bincount(row, minlength=texts)
        first = np.concatenate(([0], np.cumsum(per_row)[:-1]))
        full = np.flatnonzero(row[: n - width + 1] == row[width - 1 :]) if n >= width else np.zeros(0, np.int64)
        total = np.zeros(len(full), np.uint64)
        for k in range(width):
            total += words[full + k] * coefficient[k]
        hashes, owner = mix64(total), row[full]
        few = np.flatnonzero((per_row > 0) & (per_row < width))
        if len(few):
            short = np.zeros(len(few), np.uint64)
            for k in range(width - 1):
                has = per_row[few] > k
                short[has] += words[first[few[has]] + k] * coefficient[k]
            short = mix64(short + per_row[few].astype(np.uint64) * U(0xA0761D6478BD642F))
            hashes, owner = np.concatenate((hashes, short)), np.concatenate((owner, few))
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        yield rows, np.bincount(owner, minlength=texts), hashes


def sums_by_run(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums (mod 2**64) of consecutive runs; empty runs give 0."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences of the least width that holds them."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=U(0))
    steps[0] = 0
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_ascending(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    width = packed[0]
    body = np.frombuffer(packed, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(body), 8), np.uint8)
    wide[:, :width] = body
    steps = wide.view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64) + U(int.from_bytes(packed[1:9], "little"))
