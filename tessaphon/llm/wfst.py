"""Tokenizers as weighted transducers over the tropical semiring.

``Fst`` is a deterministic transducer: composed with a text, it leaves one path.
The normaliser is one, and so is byte fallback.  A piece transducer reads
characters and writes pieces; with the fallback it makes a union, whose arcs
read a piece, or a character without one.  Its weights decide
which of the many paths through an input is the shortest:

* Unigram models: an arc weighs minus the piece's log probability.
* Merge models (BPE): an arc weighs 0, and a bigram acceptor gives weight
  infinity to two neighbouring pieces that merging would not leave side by
  side.  A segmentation is what merging gives exactly if each pair of
  neighbours is, so one path of finite weight is left: the shortest one.

The bigram acceptor has as many arcs as there are pairs of pieces, so it is
composed lazily: a pair is worked out the first time that an input asks for it.
"""

from __future__ import annotations

import heapq
import math
import re

INF = math.inf
#: The output of an arc that writes what it reads.
COPY = object()


class Fst:
    """A deterministic transducer.

    arcs[state][symbol]: (outputs, weight, next state); under None, the arc for
    any other symbol.  Every state is final.  A COPY among the outputs is the symbol.
    """

    def __init__(self, arcs: list[dict], start: int = 0):
        self.arcs, self.start = arcs, start
        # A state whose other symbols stay in it and are copied passes runs of them at once.
        self.runs: list = [None] * len(arcs)
        # One whose only named symbol stays in it too rewrites all that follows at once.
        self.loops: list = [None] * len(arcs)
        for state, own in enumerate(arcs):
            named = "".join(re.escape(k) for k in own if isinstance(k, str))
            if len(own) == 2 and named and own.get(None) == ((COPY,), 0.0, state):
                (symbol, (outputs, weight, after)), = ((k, v) for k, v in own.items() if k is not None)
                if len(symbol) == 1 and weight == 0.0 and after == state and all(isinstance(x, str) for x in outputs):
                    self.loops[state] = (symbol, "".join(outputs))
            if named and own.get(None) == ((COPY,), 0.0, state):
                self.runs[state] = re.compile(f"[{named}]")

    def compose(self, symbols):
        """(outputs, weight) of the path that reads the symbols (a text, or bytes)."""
        out, weight, state, at, n = [], 0.0, self.start, 0, len(symbols)
        while at < n:
            if self.loops[state] is not None:
                out.append(symbols[at:].replace(*self.loops[state]))
                break
            run = self.runs[state]
            if run is not None:
                found = run.search(symbols, at)
                end = found.start() if found else n
                if end > at:
                    out.append(symbols[at:end])
                    at = end
                    continue
            symbol = symbols[at]
            outputs, w, state = self.arcs[state].get(symbol) or self.arcs[state][None]
            out += [symbol if x is COPY else x for x in outputs]
            weight += w
            at += 1
        return out, weight


class Union:
    """Pieces and byte fallback: what an arc writes and weighs, by what it reads."""

    def __init__(self, pieces: dict[str, int], fallback: Fst | None, unknown: int, weights=None):
        self.pieces, self.fallback, self.unknown, self.weights = pieces, fallback, unknown, weights or {}

    def arc(self, text: str) -> tuple[list[int], float]:
        k = self.pieces.get(text)
        if k is not None:
            return [k], self.weights.get(text, 0.0)
        return self.fallback.compose(text.encode()) if self.fallback else ([self.unknown], 0.0)


class Merges:
    """Merge rules: rank(left, right) is the rank of joining two symbols, or None."""

    def __init__(self, rank, limit: int = 1_000_000):
        self.rank, self.limit = rank, limit
        self._spines: dict[str, tuple] = {}
        self._pairs: dict[tuple[str, str], bool] = {}

    def run(self, symbols: list[str]) -> list[tuple[str, float, str, str]]:
        """Join symbols, lowest rank first and leftmost among equals; (symbol, rank, left, right) of what remains."""
        n = len(symbols)
        nodes, after, before = [(s, -1.0, None, None) for s in symbols], list(range(1, n + 1)), list(range(-1, n - 1))
        heap, number = [], 0

        def offer(i):
            nonlocal number
            j = after[i]
            if j < n:
                r = self.rank(nodes[i][0], nodes[j][0])
                if r is not None:
                    number += 1
                    heapq.heappush(heap, (r, i, number, nodes[i], nodes[j]))

        for i in range(n):
            offer(i)
        while heap:
            r, i, _, left, right = heapq.heappop(heap)
            j = after[i]
            if nodes[i] is not left or j >= n or nodes[j] is not right:
                continue
            nodes[i], nodes[j], after[i] = (left[0] + right[0], r, left, right), None, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in nodes if x is not None]

    def spine(self, piece: str, symbols: list[str]) -> tuple:
        """How a piece comes about: symbols at its left and at its right edge with the ranks at which they form."""
        got = self._spines.get(piece)
        if got is None:
            nodes = self.run(symbols)
            if len(nodes) > 1:
                got = (None, None)
            else:
                edges = []
                for side in (2, 3):
                    path, node = [], nodes[0]
                    while node is not None:
                        path.append((node[0], node[1]))
                        node = node[side]
                    edges.append(path[::-1])
                got = tuple(edges)
            self._spines[piece] = got
        return got

    def side_by_side(self, a: str, b: str, symbols) -> bool:
        """Whether merging leaves a and b as neighbours: no merge across their border comes first."""
        key = (a, b)
        got = self._pairs.get(key)
        if got is None:
            if len(self._pairs) >= self.limit:
                self._pairs.clear()
            got = self._pairs[key] = self._check(self.spine(a, symbols(a))[1], self.spine(b, symbols(b))[0])
        return got

    def _check(self, left, right) -> bool:
        if left is None or right is None:
            return False
        i = j = 0
        while True:
            next_left = left[i + 1][1] if i + 1 < len(left) else INF
            next_right = right[j + 1][1] if j + 1 < len(right) else INF
            across = self.rank(left[i][0], right[j][0])
            if across is not None and across < next_left and across <= next_right:
                return False
            if next_left == next_right == INF:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1


class MergeTransducer:
    """Characters to pieces, where the finite path is the result of merging.

    pieces: piece text to id.  symbols(text): the characters that merging
    starts from.  Where open_ is set, a character without a piece passes as
    itself and never merges.
    """

    def __init__(self, pieces: dict[str, int], merges: Merges, symbols=list, open_: bool = True):
        self.pieces, self.merges, self.symbols = pieces, merges, symbols
        self.least = 1 if open_ else 0
        self.fits: dict[tuple[int, int], bool] = {}
        #: Lengths that a piece can have, longest first, by the first three characters of what is left (fewer at the end).
        self.lengths: dict[str, tuple] = {}
        found: dict[str, set] = {}
        for p in pieces:
            if len(p) > 2:
                found.setdefault(p[:3], set()).add(len(p))
        shortest = (1,) if self.least else ()
        for key in {*found, *(p[:2] for p in pieces)}:
            own = {size for size in (1, 2) if key[:size] in pieces and len(key) >= size} | {*found.get(key, ()), *shortest}
            self.lengths[key] = tuple(sorted(own, reverse=True))

    def shortest(self, text: str) -> list[str]:
        """The pieces on the only path of finite weight, found depth first, longest arcs first."""
        number, fits, lengths, least = self.pieces.get, self.fits, self.lengths, self.least
        n, at, last, path, dead = len(text), 0, None, [], set()
        most, other = n, (1,) if least else ()
        while at < n:
            for size in lengths.get(text[at : at + 3]) or lengths.get(text[at : at + 2]) or lengths.get(text[at]) or other:
                if size > most or (dead and at + size in dead):
                    continue
                piece = text[at : at + size]
                k = number(piece)
                if k is not None:
                    if last is None:
                        break
                    ok = fits.get((last, k))
                    if ok or (ok is None and self._fit(last, k, path[-1], piece)):
                        break
                elif size == least:
                    break
            else:
                if not path:
                    raise ValueError("no path")
                dead.add(at)
                most = len(path.pop()) - 1
                at -= most + 1
                last = number(path[-1]) if path else None
                continue
            path.append(piece)
            last = k
            at += size
            most = n - at
        return path

    def _fit(self, last: int, k: int, left: str, right: str) -> bool:
        """Whether two pieces can be neighbours, remembered by their ids."""
        if len(self.fits) >= self.merges.limit:
            self.fits.clear()
        got = self.fits[last, k] = self.merges.side_by_side(left, right, self.symbols)
        return got


class UnigramTransducer:
    """Characters to pieces, where an arc weighs minus the piece's score."""

    def __init__(self, scores: dict[str, float], unknown: float):
        self.scores, self.unknown = scores, unknown
        self.longest = max(map(len, scores), default=1)

    def shortest(self, text: str) -> list[str]:
        """Shortest path by Viterbi; of equal paths, the one whose last piece is the longest."""
        n = len(text)
        cost, back = [0.0] + [INF] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                s = self.scores.get(text[start:end])
                w = -s if s is not None else self.unknown if end - start == 1 else INF
                if cost[start] + w < cost[end]:
                    cost[end], back[end] = cost[start] + w, start
        path, at = [], n
        while at:
            path.append(text[back[at] : at])
            at = back[at]
        return path[::-1]


class Memo(dict):
    """Results by key in two generations: when the younger one is full, the older one goes."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got
