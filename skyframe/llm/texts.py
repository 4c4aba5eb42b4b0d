"""Whole texts as byte buffers, words and word hashes inside Arrow functions.

Everything here works on one Arrow batch at a time: numpy over the UTF-8
bytes of many texts, no Python loop over characters. A null text counts as
an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled by one numpy pass: its arrays of eight bytes a character stay near the caches.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; offsets has one entry more than rows."""
    a = column.cast(pa.large_string())
    if a.null_count:
        a = a.fill_null("")
    n = len(a)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], dtype=np.int64, count=n + 1, offset=a.offset * 8)
    data = a.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``limit`` text bytes, one row at least."""
    n = batch.num_rows
    if n == 0:
        return
    _, off = buffers(batch.column(column))
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, min(hi, n) - lo)
        lo = hi


def regrouped(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most about ``limit`` text bytes: longer ones are cut between rows, shorter ones joined."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            n = int(buffers(part.column(column))[1][-1])
            if held and size + n > limit:
                yield _joined(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    columns = [pa.concat_arrays([p.column(i) for p in parts]) for i in range(parts[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, schema=parts[0].schema)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, per text, the index of its first word.

    The last array has one entry more than texts.
    """
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~_SPACE[buf]
    head = np.empty(n, bool)
    head[0] = True
    np.logical_not(inside[:-1], out=head[1:])
    head[off[:-1][off[:-1] < n]] = True
    head &= inside
    tail = np.empty(n, bool)
    tail[-1] = True
    np.logical_not(inside[1:], out=tail[:-1])
    last = off[1:][off[1:] > 0] - 1
    tail[last] = True
    tail &= inside
    starts = np.flatnonzero(head)
    return starts, np.flatnonzero(tail) + 1, np.searchsorted(starts, off)


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[buf]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_hash(x: np.ndarray) -> np.ndarray:
    """What ``F.hash`` gives for a long column (Murmur3 of its two halves), so that both sides deal rows alike."""
    def turn(v: np.ndarray, n: int) -> np.ndarray:
        return v << np.uint32(n) | v >> np.uint32(32 - n)

    bits = np.asarray(x, np.int64).view(np.uint64)
    h = np.full(len(bits), 42, np.uint32)
    for half in (bits & np.uint64(0xFFFFFFFF), bits >> np.uint64(32)):
        h ^= turn(half.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).view(np.int32).astype(np.int64)


_B = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BINV = pow(_B, -1, 1 << 64)
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POW: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_POW["up"])
    if have < n:
        size = max(n, 2 * have)
        for name, base in (("up", _B), ("down", _BINV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POW[name] = np.multiply.accumulate(p)
    return _POW["up"], _POW["down"]


def spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit content hash of byte spans, the same wherever the bytes stand."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_CODE[buf] * up[:len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def windows_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that start at each position (the last k-1 positions are cut)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out + word_hash[i:i + n]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(29)
    return mix(out)


def window_positions(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which a window of ``k`` words of one text starts, and their text."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    return ragged(first[:-1], counts), text


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... (count values) for each start, end to end."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.repeat(np.asarray(starts, np.int64) - begin, counts) + np.arange(total, dtype=np.int64)
