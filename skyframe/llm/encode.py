"""Token ids of whole texts with a public tokenizer, in batches.

A byte-level BPE splits a text by a pattern before it merges, and merges
never cross that split. Two kinds of places are always such a split:

* before a space or line feed whose previous character is not white space
  (a token takes at most one blank, and only as its first character);
* between a letter and one of ``! , . : ; ?`` (letters and other signs are
  never in one piece).

Texts are cut there into chunks (long texts too, so no pass holds more than
a few MB of them), equal chunks of a batch are found by Arrow's dictionary
encoding, and the library encodes each distinct chunk once. Special strings
such as ``<|endoftext|>`` hold no such place, so they stay whole and the
library treats them by its own default.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from skyframe.llm.texts import buffers, ragged

#: Text bytes whose chunks are told apart together.
SLICE_BYTES = 4 << 20

_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[33:127] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 10]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[33, 44, 46, 58, 59, 63]] = True


def cuts(buf: np.ndarray) -> np.ndarray:
    """True where a chunk may start without changing any token."""
    one = np.empty_like(buf)
    one[:1] = 0
    one[1:] = buf[:-1]
    two = np.empty_like(buf)
    two[:2] = 0
    two[2:] = buf[:-2]
    latin = (two == 0xC3) & (one >= 0x80)  # U+00C0..U+00FF
    out = _BLANK[buf] & (_GRAPHIC[one] | latin)
    out |= _SIGN[buf] & (_LETTER[one] | (latin & (one != 0x97) & (one != 0xB7)))
    return out


_SHARED: dict[str, "Encoder"] = {}


def shared_encoder(path: str) -> "Encoder":
    """One encoder per worker process and vocabulary file: a worker's tasks load it once and share its chunks."""
    if path not in _SHARED:
        _SHARED.clear()
        _SHARED[path] = Encoder(path)
    return _SHARED[path]


class Encoder:
    """Encodes texts; keeps a bounded number of encoded chunks between batches, the often seen ones longest."""

    def __init__(self, path: str, cached: int = 500_000, group: int = 50):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.cached, self.group, self.path = cached, group, path
        if path.endswith(".model"):
            import sentencepiece
            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cuttable = False
        else:
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel
            self.piece = None
            self.lib = Tokenizer.from_file(path)
            self.cuttable = isinstance(self.lib.pre_tokenizer, ByteLevel) and self.lib.normalizer is None \
                and self.lib.post_processor is None and not self.lib.pre_tokenizer.add_prefix_space
            if self.cuttable:
                size = self.lib.get_vocab_size()
                self.width = np.array([len(self.lib.id_to_token(i) or "") for i in range(size)], np.int64)
        self._clear()

    def _clear(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.counts = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.hits = np.zeros(0, np.int32)

    def _forget(self, room: int) -> None:
        """Keep the chunks that were seen again, at most half of the bound; none when ``room`` is still not there."""
        order = np.argsort(-self.hits, kind="stable")[:self.cached // 2]
        keep = np.sort(order[self.hits[order] > 1])
        if len(keep) + room > self.cached:
            self._clear()
            return
        names = list(self.seen)  # in the order of their numbers
        self.seen = {names[i]: n for n, i in enumerate(keep.tolist())}
        self.ids = self.ids[ragged(self.begins[keep], self.counts[keep])]
        self.counts = self.counts[keep]
        self.begins = np.cumsum(self.counts) - self.counts
        self.hits = self.hits[keep] // 2

    def _whole(self, texts: list[str]) -> list[list[int]]:
        if self.piece is not None:
            return self.piece.encode(texts, num_threads=1) if texts else []
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _distinct(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and token counts of distinct chunks, in their order."""
        joined = [i for i, v in enumerate(values) if v[0] == 32 and len(v) > 1 and _LETTER[v[-1]]]
        alone = np.ones(len(values), bool)
        alone[joined] = False
        single = np.flatnonzero(alone)
        texts = [b"".join([values[i] for i in joined[g:g + self.group]]).decode()
                 for g in range(0, len(joined), self.group)]
        counts = np.zeros(len(values), np.int64)
        flat = self._flat(self._whole(texts))
        if joined:
            ends = np.cumsum([len(values[i]) for i in joined])
            done = np.cumsum(self.width[flat])
            at = np.searchsorted(done, ends)
            if not np.array_equal(done[at], ends):
                raise AssertionError("a token crosses a chunk boundary")
            counts[joined] = np.diff(at + 1, prepend=0)
        own = self._whole([values[i].decode() for i in single])
        counts[single] = [len(x) for x in own]
        both = np.concatenate([flat, self._flat(own)])
        begin = np.empty(len(values), np.int64)
        order = np.concatenate([np.asarray(joined, np.int64), single])
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return both[ragged(begin, counts)], counts

    @staticmethod
    def _flat(lists: list[list[int]]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))

    def _known(self, values: list[bytes]) -> np.ndarray:
        get = self.seen.get
        return np.fromiter((get(v, -1) for v in values), np.int64, len(values))

    def _look_up(self, values: list[bytes]) -> np.ndarray:
        at = self._known(values)
        new = np.flatnonzero(at < 0)
        if len(new) and len(self.seen) and len(self.seen) + len(new) > self.cached:
            self._forget(len(new))
            at = self._known(values)
            new = np.flatnonzero(at < 0)
        self.hits[at[at >= 0]] += 1
        if len(new) == 0:
            return at
        fresh = [values[i] for i in new]
        ids, counts = self._distinct(fresh)
        at[new] = np.arange(len(self.counts), len(self.counts) + len(new))
        self.seen.update(zip(fresh, at[new].tolist()))
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.hits = np.concatenate([self.hits, np.ones(len(counts), np.int32)])
        return at

    def _part(self, buf: np.ndarray, off: np.ndarray, want_ids: bool):
        head = cuts(buf)
        head[off[:-1][off[:-1] < len(buf)]] = True
        bounds = np.flatnonzero(head)
        chunks = pa.Array.from_buffers(pa.binary(), len(bounds), [
            None, pa.py_buffer(np.append(bounds, len(buf)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf))])
        coded = chunks.dictionary_encode()
        at = self._look_up(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        counts = self.counts[at]
        total = np.concatenate([[0], np.cumsum(counts)])
        ends = total[np.searchsorted(bounds, off)]
        return ends, (self.ids[ragged(self.begins[at], counts)] if want_ids else None)

    def encode(self, column: pa.Array, want_ids: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Token offsets per text (one more than texts) and, if wanted, all ids end to end."""
        buf, off = buffers(column)
        n = len(off) - 1
        if not self.cuttable:
            lists = self._whole([x or "" for x in column.to_pylist()])
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            return ends, (self._flat(lists) if want_ids else None)
        tokens = np.zeros(n, np.int64)
        out = []
        for first, last, lo, hi in _parts(buf, off):
            inner = np.clip(off[first:last + 1], lo, hi) - lo
            ends, ids = self._part(buf[lo:hi], inner, want_ids)
            tokens[first:last] += np.diff(ends)
            if want_ids:
                out.append(ids)
        total = np.concatenate([[0], np.cumsum(tokens)])
        return total, (np.concatenate(out) if out else np.zeros(0, np.uint32)) if want_ids else None


def _parts(buf: np.ndarray, off: np.ndarray):
    """(first text, last text + 1, first byte, last byte + 1): runs of about SLICE_BYTES.

    A longer text is cut at safe places; where it has none for that long, the run grows to the next one.
    """
    n, row = len(off) - 1, 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(off, off[row] + SLICE_BYTES, side="right")) - 1)
        lo, end = int(off[row]), int(off[last])
        while end - lo > 2 * SLICE_BYTES:
            step, hi = SLICE_BYTES, end
            while lo + step < end:
                there = np.flatnonzero(cuts(buf[lo + step - SLICE_BYTES:lo + step]))
                there = there[there > 1]  # its two previous bytes are in sight
                if len(there):
                    hi = lo + step - SLICE_BYTES + int(there[-1])
                    break
                step += SLICE_BYTES
            if hi == end:
                break
            yield row, last, lo, hi
            lo = hi
        yield row, last, lo, end
        row = last
