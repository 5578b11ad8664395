"""Byte-pair encoding of whole texts with a tokenizer of the tokenizers library,
each distinct piece of text encoded once per worker."""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa

from weblode.llm.common import mix64

#: Pieces that a worker remembers before it drops those it has not met again.
REMEMBERED = 500_000
#: Groups of pieces that the library codes at a time; what it returns takes many
#: times as much as the ids.
CODED_GROUPS = 16

_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4
#: What may follow an apostrophe to make a piece of its own.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class Encoder:
    """Encodes many texts at once; ids equal those of ``encode`` text by text.

    A text is cut where the tokenizer's own pre-tokenizer (byte-level, with its
    pattern for words, numbers, other signs and white space) cuts it; which
    kind a character is, the tokenizer is asked once per character. Texts that
    hold a special token, and all texts of tokenizers of another kind, are
    encoded by the library as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.zeros(0x110000, np.uint8)
        self.size = self.tokenizer.get_vocab_size()
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else -1
        self.plain = self.newline >= 0 and self._splits_as_expected()
        self._forget()

    def _splits_as_expected(self) -> bool:
        """Whether this tokenizer cuts and joins as the fast way supposes."""
        probe = "It's 12 o'clock,  isn''t\n\n it?\n'tis 'S"
        pieces = ["It", "'s", " 12", " o", "'", "clock", ",", " ", " isn", "''", "t", "\n\n", " it", "?", "\n", "'t", "is", " '", "S"]
        step = self.tokenizer.pre_tokenizer
        if step is None or self.tokenizer.normalizer is not None:
            return False
        cuts = [probe[a:b] for _, (a, b) in step.pre_tokenize_str(probe)]
        whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
        parts = [i for p in pieces for i in self.tokenizer.encode(p, add_special_tokens=False).ids]
        return cuts == pieces and whole == parts

    def _forget(self) -> None:
        # hashes of known pieces, ascending, and the slot of each; the ids of
        # slot k are flat[first[k] : first[k + 1]]
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)  # whether slot k was met since it was last asked
        self.used = 0

    def _forget_rare(self) -> None:
        """Drops the pieces that were not met again, and all if most were."""
        keep = self.again[self.slot]
        if 2 * np.count_nonzero(keep) > REMEMBERED:
            self._forget()
            return
        low = self.first[self.slot[keep]]
        length = self.first[self.slot[keep] + 1] - low
        ends = np.cumsum(length)
        self.used = int(ends[-1]) if len(ends) else 0
        self.flat = self.flat[np.arange(self.used) + np.repeat(low - (ends - length), length)]
        self.first = np.append(0, ends)
        self.known = self.known[keep]
        self.slot = np.arange(len(ends))
        self.again = np.zeros(len(ends), bool)

    def _kinds(self, chars: np.ndarray) -> np.ndarray:
        kinds = self.kind[chars]
        if (kinds == 0).any():
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for code in np.unique(chars[kinds == 0]).tolist():
                c = chr(code)
                self.kind[code] = next((k for k, lead in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!"))
                                        if len(cut(lead + c)) == 1), _SPACE)
            kinds = self.kind[chars]
        return kinds

    def _cuts(self, chars: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        n = len(chars)
        kind = self._kinds(chars)
        first = np.zeros(n + 1, bool)  # of its text
        first[at] = True
        begin = first[:n].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        ends_run = np.append(begin[1:], True)
        space = kind == _SPACE
        # the last white space before something else is a piece of its own, or
        # leads the next piece if it is a blank
        last = space & ends_run & ~first[1:]
        begin |= last
        lead = np.flatnonzero(last & (chars == 32))
        begin[lead + 1] = False
        # an apostrophe by itself takes a short ending along
        single = np.flatnonzero((chars == 39) & begin & ends_run & ~first[1:])
        padded = np.append(chars, [0, 0, 0])
        text_end = at[np.searchsorted(at, single, side="right")]
        open_ = np.ones(len(single), bool)
        for ending in _ENDINGS:
            fits = open_ & (single + 1 + len(ending) <= text_end)
            for k, c in enumerate(ending):
                fits &= padded[single + 1 + k] == ord(c)
            hit = single[fits]
            begin[hit + 1] = False
            after = hit + 1 + len(ending)
            begin[after[after < n]] = True
            open_ &= ~fits
        # a blank that leads the piece after an ending still begins there
        return np.flatnonzero(begin)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        hard = [not self.plain or any(s in t for s in self.specials) for t in texts]
        easy = [t for t, h in zip(texts, hard, strict=True) if not h]
        ids, counts = self._fast(easy)
        if not any(hard):
            return ids, counts
        ends = np.cumsum(counts)
        pieces, out, k = [], [], 0
        for text, h in zip(texts, hard, strict=True):
            if h:
                own = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                own = ids[ends[k] - counts[k] : ends[k]]
                k += 1
            pieces.append(own)
            out.append(len(own))
        return np.concatenate(pieces) if pieces else ids, np.array(out, np.int64)

    def _fast(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=at[1:])
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        begin = self._cuts(chars, at)
        size = np.diff(np.append(begin, len(chars)))
        powers = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
        powers[0] = 1
        values = mix64(chars.astype(np.uint64) + np.uint64(1))
        values *= np.multiply.accumulate(powers)[np.arange(len(chars)) - np.repeat(begin, size)]
        keys, where, back = np.unique(
            mix64(np.add.reduceat(values, begin)) + size.astype(np.uint64), return_index=True, return_inverse=True)
        slots = self._slots(keys, joined, begin[where], size[where])
        piece = slots[back]
        low, length = self.first[piece], self.first[piece + 1] - self.first[piece]
        ends = np.cumsum(length)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(low - (ends - length), length)]
        before = np.append(0, ends)
        edges = before[np.searchsorted(begin, at)]
        return ids, np.diff(edges)

    def _slots(self, keys: np.ndarray, joined: str, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self._forget_rare()
        place = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != keys[inside]
        self.again[self.slot[place[~new]]] = True
        if new.any():
            starts, sizes = begin[new].tolist(), size[new].tolist()
            flat, lengths = self._coded([joined[a : a + n] for a, n in zip(starts, sizes, strict=True)])
            n = len(self.known)
            self.first = _room(self.first, n + len(lengths) + 1)
            self.again = _room(self.again, n + len(lengths) + 1)
            self.flat = _room(self.flat, self.used + len(flat))
            self.flat[self.used : self.used + len(flat)] = flat
            self.first[n + 1 : n + 1 + len(lengths)] = self.used + np.cumsum(lengths)
            self.used += len(flat)
            self.known = np.insert(self.known, place[new], keys[new])
            self.slot = np.insert(self.slot, place[new], n + np.arange(len(lengths)))
            place = np.searchsorted(self.known, keys)
        return self.slot[place]

    def _coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after another, and how many each has. Those
        without white space at their end go many at a time, as lines."""
        lengths = np.zeros(len(texts), np.int64)
        lines = [k for k, t in enumerate(texts) if not t[-1].isspace()]
        other = [k for k, t in enumerate(texts) if t[-1].isspace()]
        groups = [lines[low : low + 1024] for low in range(0, len(lines), 1024)]
        parts = []
        for low in range(0, len(groups), CODED_GROUPS):
            some = groups[low : low + CODED_GROUPS]
            coded = self.tokenizer.encode_batch_fast(
                ["\n".join([texts[k] for k in group]) for group in some], add_special_tokens=False)
            for group, encoding in zip(some, coded, strict=True):
                ids = np.array(encoding.ids, np.uint32)
                breaks = np.flatnonzero(ids == self.newline)
                lengths[group] = np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1
                parts.append(np.delete(ids, breaks))
        for k in other:
            parts.append(np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32))
            lengths[k] = len(parts[-1])
        # from the order they were coded in to the order asked for
        flat = np.concatenate([np.zeros(0, np.uint32), *parts])
        order = np.array(lines + other, np.int64)
        low = np.zeros(len(texts), np.int64)
        low[order] = np.cumsum(lengths[order]) - lengths[order]
        ends = np.cumsum(lengths)
        return flat[np.arange(len(flat)) + np.repeat(low - (ends - lengths), lengths)], lengths


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size < len(array):
        return array
    return np.concatenate([array, np.zeros(max(size + 1 - len(array), len(array) // 4), array.dtype)])


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]
