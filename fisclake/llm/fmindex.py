"""FM-index of integer sequences in numpy: suffix order, wavelet matrix, backward search, locating by sampled suffixes."""

from __future__ import annotations

import numpy as np

from fisclake.llm.shared import ragged


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start of each suffix, in the order of the suffixes. A suffix comes before those it begins.

    Prefix doubling: suffixes are ranked by a growing number of symbols, and only those still tied are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    sorted_symbols = symbols[order]
    new = np.r_[True, sorted_symbols[1:] != sorted_symbols[:-1]] if n else np.zeros(0, bool)
    # A group's rank is the place of its first member, so that ranks stay comparable while groups are split.
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    size = 1
    tied = _tied(new)
    while len(tied):
        starts = order[tied]
        follow = starts + size
        behind = np.full(len(starts), -1, np.int64)
        inside = follow < n
        behind[inside] = rank[follow[inside]]
        own = rank[starts]
        again = np.lexsort((behind, own))
        starts, own, behind = starts[again], own[again], behind[again]
        order[tied] = starts
        split = np.r_[True, (own[1:] != own[:-1]) | (behind[1:] != behind[:-1])]
        rank[starts] = np.maximum.accumulate(np.where(split, tied, 0))
        tied = tied[_tied(split)]
        size *= 2
    return order


def _tied(new: np.ndarray) -> np.ndarray:
    """Places whose group (begun where ``new``) has other members."""
    alone = new & np.r_[new[1:], True] if len(new) else new
    return np.flatnonzero(~alone)


class WaveletMatrix:
    """Ranks over a sequence of non-negative integers: one bit per level, with running counts of the zeros."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits, self.zeros, self.counts = bits, [], []
        for level in range(bits - 1, -1, -1):
            zero = (values >> level) & 1 == 0
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=count[1:])
            self.counts.append(count)
            self.zeros.append(int(count[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low = np.zeros(len(place), np.int64)
        for level, (zeros, count) in enumerate(zip(self.zeros, self.counts, strict=True)):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            low_zero, place_zero = count[low], count[place]
            low = np.where(one, zeros + low - low_zero, low_zero)
            place = np.where(one, zeros + place - place_zero, place_zero)
        return place - low

    def step(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        symbol, low = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        for zeros, count in zip(self.zeros, self.counts, strict=True):
            zero = count[place + 1] > count[place]
            low_zero, place_zero = count[low], count[place]
            low = np.where(zero, low_zero, zeros + low - low_zero)
            place = np.where(zero, place_zero, zeros + place - place_zero)
            symbol = 2 * symbol + ~zero
        return symbol, place - low


class FMIndex:
    """Index of a sequence over the symbols 1 to ``top``; every ``sample``-th suffix keeps its position."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = 8) -> None:
        text = np.r_[symbols.astype(np.int64), 0]  # ends with a symbol that is smaller than all others
        order = suffix_order(text)
        self.length = len(text)
        self.before = np.searchsorted(text[order], np.arange(top + 2))  # rows whose suffix begins with a smaller symbol
        self.wavelet = WaveletMatrix(text[order - 1], max(1, int(top).bit_length()))
        sampled = order % sample == 0
        self.marks = np.r_[0, np.cumsum(sampled)]
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the rows whose suffix begins with each phrase: row ``i`` of ``phrases``, its first ``lengths[i]`` symbols."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.length, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back]
            both = self.wavelet.rank(np.r_[symbol, symbol], np.r_[low[live], high[live]])
            low[live] = self.before[symbol] + both[: len(live)]
            high[live] = self.before[symbol] + both[len(live) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffix of each row begins: walk back through the text until a sampled suffix is met."""
        result, at, walked = np.zeros(len(rows), np.int64), rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            place = at[open_]
            found = self.marks[place + 1] > self.marks[place]
            done = open_[found]
            result[done] = self.positions[self.marks[at[done]]] + walked[done]
            open_ = open_[~found]
            symbol, before = self.wavelet.step(at[open_])
            at[open_] = self.before[symbol] + before
            walked[open_] += 1
        return result

    def occurrences(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the phrase and start of each occurrence."""
        low, high = self.search(phrases, lengths)
        return np.repeat(np.arange(len(lengths)), high - low), self.locate(ragged(low, high - low))
