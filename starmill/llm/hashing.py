"""Vectorised hashes of words, shingles and byte windows."""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 18


def spread(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def odd(k: int) -> np.uint64:
    """An odd multiplier of its own for each ``k``."""
    return np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1)


def codes(seed: int) -> np.ndarray:
    """One 64-bit code per byte value."""
    return spread((np.arange(1, 257, dtype=np.uint64) + np.uint64(256 * seed)) * GOLDEN)


def window_hashes(raw: np.ndarray, widths: list[int], seed: int = 0) -> dict[int, np.ndarray]:
    """For each width, the hash of the bytes from every position that has that many after it.

    Powers of two are built by doubling, other widths from them; all are mixed, not
    linear, so no input collides by its structure.
    """
    salt = GOLDEN + np.uint64(2 * seed)
    wanted = {w: None for w in widths if 0 < w <= len(raw)}
    if not wanted:
        return {w: np.zeros(0, np.uint64) for w in widths}
    current, span = codes(seed)[raw], 1
    while True:
        for w in wanted:
            if w & span:
                done = wanted[w]
                if done is None:
                    wanted[w] = current
                else:  # the lower bits cover the window's start
                    low = w & (span - 1)
                    n = len(raw) - (low + span) + 1
                    mixed = (done[:n] ^ (done[:n] >> np.uint64(29))) * (salt ^ np.uint64(0x5851F42D4C957F2D))
                    wanted[w] = mixed + current[low : low + n]
        if 2 * span > max(wanted):
            break
        left = current[:-span] * salt
        left ^= left >> np.uint64(31)
        left += current[span:]
        current, span = left, 2 * span
    return {w: (spread(wanted[w]) if w in wanted else np.zeros(0, np.uint64)) for w in widths}


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    current, span = values, 1
    while 2 * span <= width:
        current, span = np.minimum(current[:-span], current[span:]), 2 * span
    return np.minimum(current[:n], current[width - span : width - span + n])


FACTOR = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 4096)
        for name, factor in (("up", FACTOR), ("down", INVERSE)):
            steps = np.full(size, factor)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


#: A code that no byte keeps once A-Z are lower-cased, for texts in which byte 0 is part of a word.
UPPER = ord("A")


def lower_table(separators: bytes, gap: int = 0) -> np.ndarray:
    """Byte map: A-Z to a-z, separators to ``gap``, everything else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[np.frombuffer(separators, np.uint8)] = gap
    return table


def words(raw: np.ndarray, table: np.ndarray, seed: int = 7, gap: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the maximal runs of bytes that ``table`` does not map to ``gap``.

    The text is hashed piece by piece, cut between words, so memory follows the
    longest word and not the text.
    """
    code = codes(seed)
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(raw):
        upto = min(len(raw), at + PIECE)
        while upto < len(raw) and table[raw[upto]] != gap:  # not inside a word
            upto += 1
        low = table[raw[at:upto]]
        inside = np.zeros(len(low) + 2, np.int8)
        inside[1:-1] = low != gap
        edge = np.diff(inside)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(begin):
            up, down = _power_tables(len(low) + 1)
            sums = np.zeros(len(low) + 1, np.uint64)
            np.cumsum(code[low] * up[: len(low)], out=sums[1:])
            h = (sums[end] - sums[begin]) * down[begin]
            starts.append(begin + at)
            ends.append(end + at)
            hashes.append(spread(h + (end - begin).astype(np.uint64) * GOLDEN))
        at = upto
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words."""
    n = len(h) - size + 1
    if n <= 0:
        return h[:0]
    out = h[:n] * GOLDEN
    for j in range(1, size):
        out = (out ^ (out >> np.uint64(32))) * FACTOR + h[j : j + n]
    return spread(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
