"""Words and hashed word shingles of whole texts in numpy, over the bytes of an Arrow column at once.

Spans of bytes are grouped by a fast hash and then compared byte by byte, so two different spans never count as one. A
word of a shingle that is longer than 7 bytes is hashed with BLAKE2b. Long arrays are worked through in windows, whose working memory is bounded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
#: Bytes that are worked on at once; a longer word or piece is alone in its window.
WINDOW = 8 << 20
#: A salt of each place in a shingle, and of whole sequences of fewer words.
_PLACES = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: An odd 64-bit value for each byte.
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(STEP)) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_known: dict[int, np.ndarray] = {}


def power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64; kept between calls up to 2M entries."""
    found = _known.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 16), base, np.uint64)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if n <= 1 << 21:
            _known[base] = found
    return found[:n]


def fast_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans raw[starts:ends]: equal spans have equal ones, others may collide."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[raw] * power(STEP, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * power(BACK, n)[starts] + (ends - starts).astype(np.uint64))


def equal_spans(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray, others: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Whether raw[starts:starts + sizes] and other[others:others + other_sizes] hold the same bytes, span by span."""
    same = sizes == other_sizes
    todo = np.flatnonzero(same & (starts != others)) if raw is other else np.flatnonzero(same)
    done = 0
    while done < len(todo):  # parts of about WINDOW bytes
        ends = np.cumsum(sizes[todo[done:]])
        k = max(1, int(np.searchsorted(ends, WINDOW, "right")))
        part, ends = todo[done : done + k], ends[:k]
        done += k
        if not ends[-1]:
            continue
        n = sizes[part]
        inside = np.arange(ends[-1], dtype=np.int64)
        unlike = raw[inside + np.repeat(starts[part] - ends + n, n)] != other[inside + np.repeat(others[part] - ends + n, n)]
        if unlike.any():
            same[part[np.unique(np.searchsorted(ends, np.flatnonzero(unlike), "right"))]] = False
    return same


def distinct_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, first, back): the fast hash of each distinct span, one of its places, and for each span which one it is. Spans
    that share a hash with another one stand as ones of their own at the end, so that keys may repeat there."""
    sizes, hashes = ends - starts, fast_hashes(raw, starts, ends)
    keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    odd = np.flatnonzero(~equal_spans(raw, starts, sizes, raw, starts[first][back], sizes[first][back])).tolist()
    if odd:
        own: dict[bytes, int] = {}
        places = []
        for k in odd:
            span = raw[starts[k] : ends[k]].tobytes()
            if span not in own:
                own[span] = len(first) + len(own)
                places.append(k)
            back[k] = own[span]
        keys, first = np.append(keys, hashes[places]), np.append(first, places)
    return keys, first, back


def _windows(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """[lo, hi) over raw of about WINDOW bytes; all but the last end where a white space follows."""
    lo, n = 0, len(raw)
    while lo < n:
        hi = lo + WINDOW
        while hi < n:
            near = _SPACE[raw[hi : hi + 65536]]
            if near.any():
                hi += int(near.argmax())
                break
            hi += len(near)
        yield lo, (hi := min(hi, n))
        lo = hi


def _word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words ``[^\\x20\\x09-\\x0D]+`` of rows begin and end."""
    n = len(raw)
    space = _SPACE[raw]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[0] = after[-1] = True
    heads, tails = offsets[:-1], offsets[1:] - 1
    full = tails >= heads
    before[heads[full]] = True
    after[tails[full]] = True
    return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1


def _hashed_words(raw: np.ndarray, offsets: np.ndarray, hashed) -> tuple[np.ndarray, np.ndarray]:
    found, begins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in _windows(raw):
        part = _LOWER[raw[lo:hi]]
        starts, ends = _word_spans(part, np.clip(offsets, lo, hi) - lo)
        if len(starts):
            found.append(hashed(part, starts, ends))
            begins.append(starts + lo)
    return np.concatenate(found), np.searchsorted(np.concatenate(begins), offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fast hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of all rows, and for each row where
    its words begin in them (one more entry at the end). For classes of words, where collisions do no harm."""
    return _hashed_words(raw, offsets, fast_hashes)


def _strong(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each span: up to 7 bytes as they are with their number, mixed one to one; of longer ones, each distinct
    one is hashed once with BLAKE2b."""
    sizes = ends - starts
    packed = sizes.astype(np.uint64) << np.uint64(56)
    for k in range(7):
        has = np.flatnonzero(sizes > k)
        packed[has] |= raw[starts[has] + k].astype(np.uint64) << np.uint64(8 * k)
    out = mix(packed)
    long = np.flatnonzero(sizes > 7)
    if len(long):
        _, first, back = distinct_spans(raw, starts[long], ends[long])
        data, new = raw.tobytes(), hashlib.blake2b
        places = zip(starts[long][first].tolist(), ends[long][first].tolist(), strict=True)
        out[long] = np.frombuffer(b"".join([new(data[a:z], digest_size=8).digest() for a, z in places]), "<u8").astype(np.uint64)[back]
    return out


def strong_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes() without collisions that could be made on purpose."""
    return _hashed_words(raw, offsets, _strong)


def _chained(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of the columns; every step mixes all of the steps before."""
    out = mix(columns[0] + _PLACES[0])
    for k, c in enumerate(columns[1:], 1):
        out = mix((out ^ _PLACES[k]) + c * _PLACES[0])
    return out


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row its distinct shingles as sorted 64-bit hashes; a text of fewer words has its whole
    sequence as one, a text without words none."""
    words, at = strong_words(raw, offsets)
    m = len(words) - size + 1
    rolled = _chained([words[k : m + k] for k in range(size)]) if m > 0 else words[:0]
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if z - a >= size:
            found = np.sort(rolled[a : z - size + 1])
            out.append(found[np.append(True, found[1:] != found[:-1])])
        elif z > a:
            out.append(mix(_chained([words[k : k + 1] for k in range(a, z)]) + np.uint64(z - a)))
        else:
            out.append(words[:0])
    return out
