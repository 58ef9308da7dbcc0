"""Best-fit packing by a linear grouping scheme.

Documents longer than the capacity are cut into full pieces and a rest.  The
driver plans on the histogram of piece lengths, which has at most as many rows
as the capacity has tokens, however many documents there are:

1. Large lengths, in descending order, are dealt into groups of equal
   cardinality; each length counts as the largest of its group.
2. With these few sizes, the linear programme over bin configurations is solved
   by column generation, and its solution rounded down.
3. Actual documents take the places of their groups' sizes, which leaves each
   bin at least as much room as the configuration said; bins left with too much
   of it are given up again.
4. What is left, then small lengths, go best-fit, longest first, into the
   tightest room that is left; runs of equal rooms are filled in one step.

A plan is a list of allocations (a run of ranks within a length, to a run of
sequences).  Ranks come from a window within (length, hash bucket) and the
cumulated counts of the buckets, so that one very frequent length is no single
task.

Defined cases: a null or empty text is one piece, the end mark; repeated rows
are packed once each; equal lengths are interchangeable; a null id stays null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, frugal, join_checked

#: Groups of large lengths, the share of the capacity beyond which a length is
#: large, rows of a length that one window orders.
GROUPS, LARGE, TOGETHER = 64, 1 / 5, 100_000
#: Shares of the capacity beyond which the room of a configuration's sequence is too much (1: never).
LOOSE = (1, 1 / 8, 1 / 32, 1 / 128, 1 / 512)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_file: bytes, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents, with the CRC-32 of their ids (little-endian, 32 bits each)."""
    end = end_id.to_bytes(4, "little")

    def cut_up(batches):
        from .word_bpe import tokenizer

        tok = tokenizer(tokenizer_file)
        try:
            yield from _cut_up(tok, batches)
        finally:
            tok.forget()

    def _cut_up(tok, batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                ids = tok.ids(text.as_py() or "") + end
                total = len(ids) // 4
                for k, start in enumerate(range(0, total, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    for column, value in zip(out, (doc, k, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(frugal(cut_up), PIECES)


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """Pieces (a cut table with a column length) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    plan = plan_sequences(counts, capacity)
    spark = items.sparkSession
    places = spark.createDataFrame(plan or [(0, 0, 0, 0, 1, 0)], "length long, first long, n long, base long, per long, step long")
    buckets = max(1, -(-total // TOGETHER))
    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")), "pack-ranks")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = join_checked(dealt.withColumn("k", F.row_number().over(inside) - 1), offsets, ["length", "bucket"]).withColumn("rank", F.col("ahead") + F.col("k")).drop("ahead", "k", "bucket")
    # The plan has a bounded number of rows: a few for each length up to the capacity.
    p = F.broadcast(places.withColumnRenamed("length", "of"))
    placed = ranked.join(p, (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
    at = F.col("rank") - F.col("first")
    placed = placed.withColumn("sequence_id", F.col("base") + F.floor(at / F.col("per"))).withColumn("turn", at % F.col("per"))
    order = Window.partitionBy("sequence_id").orderBy("step", "turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    return placed.drop("of", "first", "n", "base", "per", "step", "turn", "rank")


def plan_sequences(counts: dict[int, int], capacity: int, groups: int = GROUPS, large: float = LARGE) -> list[tuple[int, int, int, int, int, int]]:
    """Allocations (length, first rank, ranks, first sequence, ranks in a sequence, step).

    Sequences of a configuration that actual documents leave with too much room
    are given up before the best fit; of a few measures of too much, that which
    needs the fewest sequences holds.
    """
    lengths = sorted((n for n in counts if counts[n]), reverse=True)
    if lengths and (lengths[0] > capacity or lengths[-1] < 1):
        raise ValueError("lengths must be between 1 and the capacity")
    big = [n for n in lengths if large * capacity < n < capacity]
    if not big:
        return _fill(counts, capacity, lengths, [], None, [], capacity).rows
    starts = np.concatenate([[0], np.cumsum([counts[n] for n in big])])
    total = int(starts[-1])
    each = -(-total // groups)
    firsts = list(range(0, total, each))
    sizes = np.array([big[int(np.searchsorted(starts, f, "right")) - 1] for f in firsts])
    wanted = np.array([min(each, total - f) for f in firsts])
    used = np.zeros(len(firsts), dtype=np.int64)
    runs = []
    for config, times in configurations(sizes, wanted, capacity, int(1 / large)):
        times = int(min([times, *((wanted[g] - used[g]) // a for g, a in config)]))
        if times < 1:
            continue
        places = []
        for g, a in config:
            for _ in range(a):
                places.append(firsts[g] + int(used[g]))
                used[g] += times
        runs.append((times, places))
    rest = [(f + int(u), f + int(w)) for f, u, w in zip(firsts, used, wanted, strict=True) if u < w]
    plans = [_fill(counts, capacity, lengths, big, starts, runs, int(capacity * share), rest) for share in LOOSE]
    return min(plans, key=lambda p: p.sequences).rows


def _fill(counts, capacity: int, lengths, big, starts, runs, loose: int, rest=()) -> _Plan:
    """The plan that keeps the configurations' sequences with up to ``loose`` room before the best fit."""
    plan, later = _Plan(capacity), []
    if counts.get(capacity):
        plan.place(capacity, 0, counts[capacity], plan.open(counts[capacity]), 1)
    for times, places in runs:
        # Within a piece, the documents at each place have one length.
        edges = {0, times}
        for at in places:
            first, last = np.searchsorted(starts, [at, at + times - 1], "right")
            edges.update(int(x) - at for x in starts[first:last] if at < x < at + times)
        points = sorted(edges)
        for a, b in zip(points, points[1:], strict=False):
            found = [int(np.searchsorted(starts, at + a, "right")) - 1 for at in places]
            room = capacity - sum(big[k] for k in found)
            if room > loose:
                later += [(big[k], at + a - int(starts[k]), b - a) for k, at in zip(found, places, strict=True)]
                continue
            base = plan.open(b - a)
            for k, at in zip(found, places, strict=True):
                plan.place(big[k], at + a - int(starts[k]), b - a, base, 1)
            plan.add_room(room, base, b - a)
    for a, b in rest:
        later += _runs(big, starts, a, b)
    for n, rank, k in sorted(later, key=lambda x: -x[0]):
        plan.best_fit(n, rank, k)
    large = set(big)
    for n in lengths:
        if n < capacity and n not in large:
            plan.best_fit(n, 0, counts[n])
    return plan


def _runs(lengths, starts, a: int, b: int):
    """Positions a to b of the descending list, as (length, first rank, ranks)."""
    k = int(np.searchsorted(starts, a, "right")) - 1
    while a < b:
        end = min(b, int(starts[k + 1]))
        if end > a:
            yield lengths[k], a - int(starts[k]), end - a
        a, k = end, k + 1


class _Plan:
    def __init__(self, capacity: int):
        self.capacity, self.rows, self.sequences = capacity, [], 0
        self.rooms: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def place(self, length: int, rank: int, n: int, base: int, per: int) -> None:
        self.rows.append((length, rank, n, base, per, len(self.rows)))

    def add_room(self, room: int, base: int, n: int) -> None:
        if n and room:
            self.rooms[room].append((base, n))

    def best_fit(self, length: int, rank: int, n: int) -> None:
        room = length
        while n:
            while room <= self.capacity and not self.rooms[room]:
                room += 1
            if room > self.capacity:
                room, bins = self.capacity, -(-n // (self.capacity // length))
                base = self.open(bins)
            else:
                base, bins = self.rooms[room].pop()
            per = room // length
            full = min(bins, n // per)
            if full:
                self.place(length, rank, full * per, base, per)
                self.add_room(room - per * length, base, full)
                rank, n, base, bins = rank + full * per, n - full * per, base + full, bins - full
            if bins and n:
                self.place(length, rank, n, base, n)
                self.add_room(room - n * length, base, 1)
                n, base, bins = 0, base + 1, bins - 1
            self.add_room(room, base, bins)


def configurations(sizes, wanted, capacity: int, most: int, rounds: int = 3000):
    """(configuration, times) of the linear programme's solution, times rounded down.

    A configuration is a list of (size index, how many).  Columns come from the
    knapsack over the dual prices, with at most ``most`` places.
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    demand = wanted.astype(float)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        column, value = _knapsack(sizes, prices, capacity, most)
        if value <= 1 + 1e-9:
            break
        times, step = np.linalg.solve(basis, demand), np.linalg.solve(basis, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(times, 0) / step, np.inf)
        basis[:, int(np.argmin(ratio))] = column
    times = np.floor(np.maximum(np.linalg.solve(basis, demand), 0) + 1e-6)
    for j in np.argsort(-times, kind="stable"):
        if times[j] >= 1:
            yield [(int(g), int(basis[g, j])) for g in np.flatnonzero(basis[:, j])], int(times[j])


def _knapsack(sizes, prices, capacity: int, most: int):
    best, choices = np.zeros(capacity + 1), []
    for _ in range(most):
        options = np.full((len(sizes) + 1, capacity + 1), -np.inf)
        options[-1] = best
        for g, w in enumerate(sizes):
            options[g, w:] = best[: capacity + 1 - w] + prices[g]
        choice = options.argmax(axis=0)
        best = options[choice, np.arange(capacity + 1)]
        choices.append(choice)
    column, room = np.zeros(len(sizes)), capacity
    for choice in reversed(choices):
        g = choice[room]
        if g < len(sizes):
            column[g] += 1
            room -= sizes[g]
    return column, best[capacity]
