"""Repeated word windows by backward search in compressed FM-indexes.

Each shard indexes its different stretches of text: words become numbers, suffixes are
sorted, and the transform of the stretches is kept as a wavelet matrix of bit vectors with
rank counts. The stretches are streamed against the index from right to left, many at a
time. A match grows word by word while it still occurs at least twice; the lengths reached
are the matching statistics, and where they reach the threshold an interval is reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventguard.llm.common import beside
from eventguard.llm.routing import RouteConfig, merged, repeated_intervals


@dataclass(frozen=True)
class SubstringConfig:
    window: int = 50
    gram: int = 8
    probe: int = 8

    @property
    def route(self) -> RouteConfig:
        return RouteConfig(self.window, self.gram, words=True)


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence, one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray):
        self.depth = max(int(symbols.max(initial=0)).bit_length(), 1)
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.depth - 1, -1, -1):
            ones = (symbols >> level) & 1 == 1
            self.levels.append((Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def positions(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where place i stands among the occurrences of the symbol, offset by all smaller paths."""
        for level, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels):
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1 == 1, zeros + ones, i - ones)
        return i


def suffix_order(keys: np.ndarray, depth: int, width: int = 1) -> np.ndarray:
    """Order of suffixes by their first `depth` symbols, by doubling ranks.

    `keys` order the suffixes by their first `width` symbols. A round sorts only suffixes that
    are still equal to others; a rank is the first place of the suffixes that are equal so far.
    """
    n = len(keys)
    order = np.argsort(keys)
    places, keys = np.arange(n), keys[order]
    rank = np.empty(n, np.int64)
    while n:
        head = np.ones(len(keys), bool)
        head[1:] = keys[1:] != keys[:-1]
        rank[order[places]] = places[head][np.cumsum(head) - 1]
        equal = ~head
        equal[:-1] |= ~head[1:]
        places = places[equal]
        if width >= depth or not len(places):
            break
        here = order[places]
        behind = here + width
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        keys = rank[here] * (n + 1) + second
        deal = np.argsort(keys)
        order[places], keys = here[deal], keys[deal]
        width *= 2
    return order


class FmIndex:
    """Index of stretches of word numbers from 0 on; a match never runs across stretches."""

    def __init__(self, stretches: list[np.ndarray], weights: np.ndarray):
        n = len(stretches)
        sizes = np.array([len(s) for s in stretches], np.int64)
        # Each stretch ends with a number of its own below all words, so suffixes all differ.
        flat = np.empty(int(sizes.sum()) + n, np.int64)
        ends = np.cumsum(sizes + 1) - 1
        words = np.ones(len(flat), bool)
        words[ends] = False
        flat[words] = np.concatenate(stretches) + n
        flat[ends] = np.arange(n)
        order = suffix_order(flat, int(sizes.max(initial=0)) + 1)
        self.starts = ends - sizes
        before = flat[order - 1]  # of the first symbol: the last end, which is never asked for
        plain = np.maximum(before - n + 1, 0)  # all ends are one symbol, 0, in the transform
        self.matrix = WaveletMatrix(plain)
        kinds = np.arange(int(plain.max(initial=0)) + 1)
        self.base = self.matrix.positions(kinds, np.zeros(len(kinds), np.int64))
        counts = np.bincount(np.maximum(flat - n + 1, 0), minlength=len(kinds))
        self.first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(n), sizes + 1)
        self.weight = np.concatenate([[0], np.cumsum(weights[owner][order])])
        self.flat, self.sizes, self.size = np.maximum(flat - n + 1, 0), sizes, len(flat)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the match with a symbol put in front."""
        both = self.matrix.positions(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.first[symbol] - self.base[symbol]
        return both[:len(low)] + shift, both[len(low):] + shift

    def matching_intervals(self, window: int, probe: int) -> list[list[tuple[int, int]]]:
        """Per stretch, what windows that occur at least twice cover.

        A lane per stretch holds the end of its match and the place in front of it. Where a
        match can not grow to the left, no window holds it: if already its first `probe`
        words are unique, the next match ends in front of them, else one word earlier.
        """
        n = len(self.sizes)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        end = self.sizes - 1
        place, goal, old = end.copy(), np.full(n, -1), np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), np.full(n, self.size)
        lanes = np.flatnonzero(self.sizes >= window)
        while len(lanes):
            symbol = self.flat[self.starts[lanes] + place[lanes]]
            a, b = self.extend(symbol, low[lanes], high[lanes])
            twice = self.weight[b] - self.weight[a] >= 2
            go, stop = lanes[twice], lanes[~twice]
            low[go], high[go] = a[twice], b[twice]
            place[go] -= 1
            probing = goal[go] >= 0
            # A probe that got through: the failed match was only too long.
            passed = go[probing & (place[go] < goal[go])]
            whole = go[~probing & (place[go] < 0)]
            reset_to = np.full(n, -2)
            reset_to[passed] = np.minimum(old[passed] - 1, goal[passed] + window - 1)
            goal[passed] = -1
            for lane in whole.tolist():
                if end[lane] + 1 >= window:
                    found[lane].append((0, int(end[lane]) + 1))
            reset_to[whole] = -1
            failed = stop[goal[stop] >= 0]
            reset_to[failed] = end[failed] - 1
            goal[failed] = -1
            normal = stop[(reset_to[stop] == -2)]
            length = end[normal] - place[normal]
            for lane in normal[length >= window].tolist():
                found[lane].append((int(place[lane]) + 1, int(end[lane]) + 1))
            try_probe = length >= probe
            probes, plain = normal[try_probe], normal[~try_probe]
            old[probes], goal[probes] = end[probes], place[probes]
            reset_to[plain] = np.minimum(end[plain] - 1, place[plain] + window - 1)
            restart = np.flatnonzero(reset_to > -2)
            end[restart] = reset_to[restart]
            end[probes] = goal[probes] + probe - 1
            again = np.concatenate([restart, probes])
            place[again] = end[again]
            low[again], high[again] = 0, self.size
            # Behind a probe the end may be short; only windows that still fit are sought.
            done = np.zeros(n, bool)
            done[restart] = end[restart] < window - 1
            lanes = lanes[~done[lanes]]
        return found


def repeated_windows(contents: list[bytes], counts: np.ndarray, cfg: SubstringConfig) -> list[list[tuple[int, int]]]:
    """Intervals of each stretch that windows occurring again cover. A repeated stretch is covered whole."""
    split = [c.split() for c in contents]
    number: dict[bytes, int] = {}
    stretches = [
        np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in split
    ]
    if not stretches:
        return []
    index = FmIndex(stretches, counts)
    found = index.matching_intervals(cfg.window, cfg.probe)
    return [
        [(0, len(words))] if n > 1 else sorted(own) for words, n, own in zip(stretches, counts.tolist(), found)
    ]


def remove_repeats(
    df: DataFrame, keep: list[str], text: str = "text", cfg: SubstringConfig = SubstringConfig()
) -> DataFrame:
    """The `keep` columns of each row, n_words, n_removed, `kept_text` and kept_sha256.

    A word goes if a window of `window` words that covers it occurs more than once, counting
    the same text; kept words are joined by one blank. A null text has no words. Rows that
    are equal are repeats of each other. A kept column that is called like a result gives way to it.
    """
    keep = beside(keep, "n_words", "n_removed", "kept_text", "kept_sha256")
    found = repeated_intervals(df, keep, text, cfg.route, lambda c, n: repeated_windows(c, n, cfg))
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, gone, texts, sums = [], [], [], []
            for raw, spans in zip(part.column("_text").to_pylist(), part.column("_spans").to_pylist()):
                words = raw.split()
                kept, at = [], 0
                for a, b in merged(spans):
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                joined = b" ".join(kept)
                sizes.append(len(words))
                gone.append(len(words) - len(kept))
                texts.append(joined.decode())
                sums.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays([
                *part.columns[:len(keep)], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(texts, pa.string()), pa.array(sums, pa.string()),
            ], names=[*keep, "n_words", "n_removed", "kept_text", "kept_sha256"])

    return found.mapInArrow(
        cut, ", ".join([*fields, "n_words long", "n_removed long", "kept_text string", "kept_sha256 string"])
    )
