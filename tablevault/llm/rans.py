"""Range asymmetric numeral system with a static table, in interleaved lanes.

Symbol ``i`` of a block belongs to lane ``i % LANES``; every lane has a 64-bit
state that is renormalised by 32-bit words. A step codes one symbol of each
lane with array operations. Checkpoints hold all states and the place in the
words every ``CHECKPOINT_STEPS`` steps, so parts of a block decode alone.
"""

from __future__ import annotations

import numpy as np

LANES = 2048
SCALE = 18  # frequencies sum to 2**SCALE
CHECKPOINT_STEPS = 128
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_SCALE = np.uint64(SCALE)
_MASK = np.uint64((1 << SCALE) - 1)


class Table:
    """Frequencies of the symbols that occur, scaled to sum to 2**SCALE."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols, self.freqs = symbols.astype(np.uint32), freqs.astype(np.uint32)
        top = int(symbols.max()) + 1 if len(symbols) else 1
        cum = np.concatenate([[0], np.cumsum(freqs)[:-1]]) if len(freqs) else np.zeros(0)
        self.freq, self.cum = np.zeros(top, np.uint64), np.zeros(top, np.uint64)
        self.freq[symbols], self.cum[symbols] = freqs, cum
        self.of_slot = np.repeat(self.symbols if top > 1 << 16 else self.symbols.astype(np.uint16), freqs)

    @classmethod
    def count(cls, ids: np.ndarray) -> Table:
        """The table of a sequence of symbols (not empty for a useful one)."""
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        if len(symbols) > 1 << SCALE:
            raise ValueError(f"more than {1 << SCALE} distinct symbols")
        if not len(symbols):
            return cls(symbols, symbols)
        freqs = np.maximum(1, counts[symbols] * (1 << SCALE) // counts.sum())
        spare = (1 << SCALE) - int(freqs.sum())
        order = np.argsort(-freqs, kind="stable")
        k = 0
        while spare:  # the most frequent take what rounding left or took
            take = spare if spare > 0 else max(spare, 1 - int(freqs[order[k]]))
            freqs[order[k]] += take
            spare -= take
            k += 1
        return cls(symbols, freqs)


def encode(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(states, words, checkpoints)``: states to start decoding with, coded
    words, and a row ``(step, word, states...)`` for each checkpoint."""
    n = len(ids)
    x = np.full(LANES, _LOW)
    words, kept, count = [], [], 0
    limit = np.uint64(63 - SCALE)
    for step in range(-(-n // LANES) - 1, -1, -1):
        s = ids[step * LANES:(step + 1) * LANES]
        f, y = table.freq[s], x[:len(s)]
        big = y >= (f << limit)
        out = y[big]
        words.append(out.astype(np.uint32))  # the low half
        count += len(out)
        y[big] = out >> _32
        q = y // f
        x[:len(s)] = (q << _SCALE) + (y - q * f) + table.cum[s]
        if step and step % CHECKPOINT_STEPS == 0:
            kept.append((step, count, x.copy()))
    coded = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    marks = np.zeros((len(kept), LANES + 2), np.uint64)
    for row, (step, have, states) in zip(marks, reversed(kept)):
        row[0], row[1], row[2:] = step, count - have, states
    return x, coded, marks


def decode(n: int, table: Table, states: np.ndarray, words: np.ndarray, first: int = 0, word: int = 0,
           last: int | None = None) -> np.ndarray:
    """Symbols of the steps ``first`` to ``last`` (all to the end by default) of a
    block of ``n`` symbols, from the states and the word at ``first``."""
    steps = -(-n // LANES) if last is None else last
    out = np.empty(max(0, min(n, steps * LANES) - first * LANES), np.uint32)
    x = states.copy()
    for step in range(first, steps):
        k = min(LANES, n - step * LANES)
        y = x[:k]
        slot = y & _MASK
        s = table.of_slot[slot]
        at = (step - first) * LANES
        out[at:at + k] = s
        y = table.freq[s] * (y >> _SCALE) + slot - table.cum[s]
        low = np.flatnonzero(y < _LOW)
        y[low] = (y[low] << _32) | words[word:word + len(low)]
        word += len(low)
        x[:k] = y
    return out
