"""Words and shingles of many texts at once, computed with numpy on their UTF-8 bytes.

Texts reach a task as Arrow batches. ``chunks`` cuts a batch into runs of whole texts of bounded size; a text above
the bound is a run of its own, and its bytes are still worked on block by block, so memory beyond the text itself is
eight bytes a word. A word's hash is a polynomial over its bytes modulo 2**64, read off running sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
BLOCK = 1 << 18
SHINGLE = 5

_MASK = (1 << 64) - 1


def _stream(seed: int) -> Iterator[int]:
    """The splitmix64 sequence."""
    while True:
        seed = (seed + 0x9E3779B97F4A7C15) & _MASK
        z = ((seed ^ (seed >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        yield z ^ (z >> 31)


def odd_numbers(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers, the same on every machine."""
    source = _stream(seed)
    return np.array([next(source) | 1 for _ in range(n)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = next(_stream(7)) | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTORS = odd_numbers(11, SHINGLE)
_LENGTH_FACTOR = np.uint64(next(_stream(13)) | 1)


def _byte_values(fold: bool) -> np.ndarray:
    """A random value per byte; with ``fold``, A-Z have the values of a-z."""
    values = odd_numbers(17, 256)
    if fold:
        values[65:91] = values[97:123]
    return values


def _is_word_byte(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
PUNCTUATED = bytes(b for b in range(128) if not chr(b).isalnum())
_VALUES = {True: _byte_values(True), False: _byte_values(False)}
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(BLOCK + 1, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0]:starts[-1]], starts - starts[0]


def chunks(starts: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together, or of one text."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _blocks(data: np.ndarray, cuts: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK`` bytes that end where no word crosses: at a separator or a text's end."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        while end < n:
            gap = np.flatnonzero(~is_word[data[end:end + BLOCK]])
            cut = np.searchsorted(cuts, end)
            near = min(end + int(gap[0]) if len(gap) else n, int(cuts[cut]) if cut < len(cuts) else n)
            if near <= end + BLOCK or near >= n:
                end = near
                break
            end += BLOCK
        yield at, end
        at = end


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges given, which follow each other."""
    out, at, n = np.empty(len(begin), np.uint64), 0, len(begin)
    while at < n:
        upto = max(at + 1, int(np.searchsorted(end, begin[at] + BLOCK, side="right")))
        low, high = int(begin[at]), int(end[upto - 1])
        up, down = _powers(high - low)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_VALUES[False][data[low:high]] * up[:high - low], out=sums[1:])
        a, b = begin[at:upto] - low, end[at:upto] - low
        out[at:upto] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _LENGTH_FACTOR)
        at = upto
    return out


def word_spans(data: np.ndarray, starts: np.ndarray, fold: bool = True,
               separators: bytes = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the words' hashes, their first bytes, their ends, and the number of words before each text."""
    is_word, values = _is_word_byte(separators), _VALUES[fold]
    cuts = starts[(starts > 0) & (starts < len(data))]
    hashes, begins, ends = [], [], []
    for a, b in _blocks(data, cuts, is_word):
        block = data[a:b]
        inside = is_word[block]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        own = cuts[(cuts > a) & (cuts < b)] - a
        first[own] = inside[own]
        last[own - 1] = inside[own - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(begin):
            continue
        up, down = _powers(len(block))
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(values[block] * up[:len(block)], out=sums[1:])
        h = (sums[end] - sums[begin]) * down[begin]
        h += (end - begin).astype(np.uint64) * _LENGTH_FACTOR
        hashes.append(mix(h))
        begins.append(begin + a)
        ends.append(end + a)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(starts), np.int64)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), begin, np.concatenate(ends), np.searchsorted(begin, starts)


def shingles(hashes: np.ndarray, words_before: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' word n-grams in order, and their number before each text.

    A text of fewer words than ``width`` has one shingle, its whole sequence; a text without words has none.
    """
    n = len(hashes)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += padded[k:k + n] * _FACTORS[k]
    lengths = np.diff(words_before)
    valid = np.ones(n, dtype=bool)
    for k in range(1, width):
        valid[(words_before[1:] - k)[lengths >= k]] = False
    for i in np.flatnonzero((lengths > 0) & (lengths < width)):
        a, b = words_before[i], words_before[i + 1]
        total[a] = (hashes[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
        valid[a] = True
    counts = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
    return mix(total[valid]), np.concatenate([[0], np.cumsum(counts)])


def distinct_per_text(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats."""
    values = values.copy()
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    firsts = before[:-1][np.diff(before) > 0]
    keep[firsts] = True
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], kept_before[before]


def text_shingles(column: pa.Array, separators: bytes = WHITE,
                  fold: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each run of texts ``[i, j)``: their distinct shingles, and the number before each text."""
    data, starts = text_buffer(column)
    for i, j in chunks(starts):
        part, offsets = data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]
        hashes, _, _, before = word_spans(part, offsets, fold, separators)
        yield i, j, *distinct_per_text(*shingles(hashes, before))
