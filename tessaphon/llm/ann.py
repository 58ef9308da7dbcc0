"""Approximate nearest neighbours by inner product: NN-descent and graph search, by block.

Index.  Equal vectors are one node.  One more component makes all nodes equally
long, so that a nearest node is one of the largest inner product.  Nodes are
dealt into blocks by a hash of their number; their number grows with the square
root of the table, and a block has about BLOCK nodes at most.  Each block has a graph of its own, made in one task: its nodes
are sorted by the signs of random projections, several times, and compared
within windows of the order: the first graph.  Rounds of NN-descent follow: neighbours
of a node, in both directions of the edges, are compared, and each pair that beats the worst
neighbour that a node has goes to its list, which keeps the best.  The rounds
end when they change less than a hundredth of the block's graph.

Search.  Blocks are written once, with vectors and graph, to the shared folder.  A task has
some of the queries, reads one block after the other and walks its graph with all of
them; every query walks every block.  A query's state is a bounded list of the best nodes so far; in each round, the
best of those not yet expanded give their neighbours, which are scored, and the
list keeps the best.  A walk ends when no node is left that isn't
expanded.  The list, the nodes expanded in a round and the starts grow with the
square root of the block.  A query starts at its own node, at the best of some nodes of the
block, and at its longest nodes if it is shorter.  A query that the graphs leave with too few nodes is
compared with all vectors.

Every row is indexed; hot vectors are one node; a node's in-edges are cut to
the best before they meet.  Lists travel packed (ids and scores as bytes).

Defined cases: vectors that are null, zero, of another size than most, or hold
null or non-finite components take no part, nor do null ids; of several vectors
of one id the first in byte order counts; repeated rows count once; equal
scores rank by the smaller id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, forget, fresh, frugal, remove

#: Neighbours kept; trees and window of the first graph; share of new neighbours below which rounds end; neighbours
#: compared at a node; best of them that one node is told; search list, expansions in a round; most nodes in a block.
DEGREE, TREES, WINDOW, CONVERGED, MET, TOLD, LIST, EXPAND, BLOCK = 48, 6, 1024, 0.01, 40, 16, 160, 40, 1 << 15
#: Nodes of a table at one block, four times as many at two and so on.
SPREAD = 2_000
#: What nodes are told at once before their lists are cut down; queries that a task holds, and walks with at once.
HELD, SLICE, TOGETHER = 1 << 20, 4096, 64
#: Longest nodes from which a query starts, besides its own, if it is shorter than they are.
LONGEST = 96
#: Nodes whose neighbours are compared at once in a task.
ROWS = 512
#: Nodes up to which LIST, EXPAND and LONGEST hold as they are.
SMALL = 10_000


def _i8(x) -> bytes:
    return np.ascontiguousarray(x, "<i8").tobytes()


def _f4(x) -> bytes:
    return np.ascontiguousarray(x, "<f4").tobytes()


def _best(ids, scores, most: int, own=None):
    """The best distinct ids, best first, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first.sort()
    if own is not None:
        first = first[ids[first] != own]
    return ids[first[:most]], scores[first[:most]]


def _flat(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed values, and how many each row has."""
    if not len(column):
        return np.empty(0, kind), np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "<i8" if pa.types.is_large_binary(column.type) else "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind) if at[-1] > at[0] else np.empty(0, kind)
    return values, np.diff(at) // np.dtype(kind).itemsize


def _packed(values: np.ndarray, sizes: np.ndarray):
    """The column that ``_flat`` takes apart."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(values.tobytes())])


def _best_of_rows(row, ids, scores, old, own, most: int):
    """``_best`` for many rows at once: the ids and scores, how many each row has, how many of those aren't old in any list."""
    order = np.lexsort((-scores, ids, row))
    row, ids, scores, old = row[order], ids[order], scores[order], old[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])])) if len(row) else np.empty(0, np.int64)
    new = ~np.logical_or.reduceat(old, first) if len(first) else np.empty(0, bool)
    row, ids, scores = row[first], ids[first], scores[first]
    other = ids != own[row]
    row, ids, scores, new = row[other], ids[other], scores[other], new[other]
    order = np.lexsort((ids, -scores, row))
    row, ids, scores, new = row[order], ids[order], scores[order], new[order]
    good = np.arange(len(row)) - np.searchsorted(row, np.arange(len(own)))[row] < most
    row = row[good]
    return ids[good], scores[good], np.bincount(row, minlength=len(own)), np.bincount(row[new[good]], minlength=len(own))


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (packed doubles) of the rows that take part, once for each id; a cut table."""
    sizes = table.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").limit(1).collect()
    size = most[0]["size"] if most else 0

    def pack(batches):
        for batch in batches:
            column = batch[1]
            flat = column.flatten().cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False).reshape(-1, size) if size else np.empty((0, 0))
            good = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
            ids = batch[0].to_numpy(zero_copy_only=False)[good]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([v.tobytes() for v in values[good]], pa.binary())], ["id", "vec"])

    some = table.filter(F.col(id_col).isNotNull() & (F.size(vec_col) == size)).select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"))
    return cut(some.mapInArrow(pack, "id long, vec binary").groupBy("id").agg(F.min("vec").alias("vec")), "ann-vectors")


def build(table: DataFrame, degree: int = DEGREE, trees: int = TREES, window: int = WINDOW, converged: float = CONVERGED) -> tuple[DataFrame, DataFrame]:
    """table: id, vec.  Cut tables: nodes (node, vec, gvec) and graph (node, ids, scores)."""
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = table.groupBy("vec").agg(F.min("id").alias("node")).select("node", "vec")

    def squares(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float((np.frombuffer(v.as_py()) ** 2).sum()) for v in batch[0]], pa.float64())], ["s"])

    top = nodes.select("vec").mapInArrow(squares, "s double").agg(F.max("s")).first()[0] or 1.0

    def lengthen(batches):
        for batch in batches:
            out = []
            for v in batch[1]:
                x = np.frombuffer(v.as_py())
                out.append((np.append(x, max(0.0, top - (x**2).sum()) ** 0.5) / top**0.5).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(out, pa.binary())], ["node", "vec", "gvec"])

    nodes = cut(nodes.mapInArrow(lengthen, "node long, vec binary, gvec binary"), "ann-nodes")
    blocks = _blocks(nodes.count())

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_block(batch[0].to_numpy(), blocks)), batch[0], batch[1]], ["block", "node", "gvec"])

    def make(batches):
        for _, rows in _by_block(batches):
            ids = rows["node"].to_numpy()
            x = _flat(rows["gvec"].combine_chunks(), "<f4")[0].reshape(len(ids), -1)
            near, found = neighbours(x, degree, trees, window, converged)
            for at in range(0, len(ids), ROWS):
                some = near[at : at + ROWS] >= 0
                kept = some.sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + ROWS]), _packed(ids[near[at : at + ROWS][some]], kept), _packed(found[at : at + ROWS][some], kept)], ["node", "ids", "scores"])

    dealt = nodes.select("node", "gvec").mapInArrow(place, "block long, node long, gvec binary").repartition(parts, "block").sortWithinPartitions("block", "node")
    return nodes, cut(dealt.mapInArrow(frugal(make), "node long, ids binary, scores binary"), "ann-graph")


def _blocks(n: int) -> int:
    """Blocks for n nodes."""
    return max(1, -(-n // BLOCK), int(np.ceil((n / SPREAD) ** 0.5)))


def _by_block(batches):
    """block and rows, for batches sorted by block (column 0)."""
    held, last = [], None
    for batch in batches:
        of = batch[0].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if held and of[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = int(of[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


def neighbours(x: np.ndarray, degree: int, trees: int, window: int, converged: float) -> tuple[np.ndarray, np.ndarray]:
    """The graph of a block: for each row of x the numbers of its best neighbours, best first (-1: none), and their products."""
    n = len(x)
    near, found = np.full((n, degree), -1, np.int32), np.full((n, degree), -np.inf, np.float32)
    bits = max(1, int(np.ceil(np.log2(max(2, n / (window / 8))))))
    step = window * 2 // 3
    for tree in range(trees if n > window else 1):
        along = x @ np.random.default_rng(1000 + tree).standard_normal((x.shape[1], bits + 1)).astype(np.float32)
        order = np.lexsort((along[:, bits], ((along[:, :bits] > 0) << np.arange(bits - 1, -1, -1)).sum(axis=1))).astype(np.int32)
        for at in range(0, max(1, n - window + step), step):
            ids = order[at : at + window]
            s = x[ids] @ x[ids].T
            np.fill_diagonal(s, -np.inf)
            k = min(degree, len(ids) - 1)
            if k > 0:
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                _take_in(near, found, ids, ids[top], np.take_along_axis(s, top, 1))
    while n > window:  # ends by itself: what a list takes in is better than what it loses
        if _descend(x, near, found) <= converged * near.size:
            break
    return near, found


def _take_in(near, found, at, more, scores) -> int:
    """Put the best of lists of more into those at some rows; how many they take in."""
    degree, taken = near.shape[1], 0
    for a in range(0, len(at), 2048):
        rows = at[a : a + 2048]
        ids = np.concatenate([near[rows], more[a : a + 2048]], axis=1)
        s = np.concatenate([found[rows], scores[a : a + 2048]], axis=1)
        order = np.argsort(ids, axis=1, kind="stable")
        ids, s = np.take_along_axis(ids, order, 1), np.take_along_axis(s, order, 1)
        s[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
        best = np.lexsort((ids, -s), axis=1)[:, :degree]
        s = np.take_along_axis(s, best, 1)
        near[rows] = np.where(np.isfinite(s), np.take_along_axis(ids, best, 1), -1)
        found[rows] = s
        taken += int((np.isfinite(s) & (np.take_along_axis(order, best, 1) >= degree)).sum())
    return taken


def _padded(at, ids, scores, most: int):
    """Rows that have any, and the best distinct ids of each, with scores (-1 and -inf: none)."""
    rows, of = np.unique(at, return_inverse=True)
    ids, scores, kept, _ = _best_of_rows(of, ids, scores, np.zeros(len(ids), bool), np.full(len(rows), -1), most)
    out, s = np.full((len(rows), most), -1, np.int32), np.full((len(rows), most), -np.inf, np.float32)
    good = np.arange(most) < kept[:, None]
    out[good], s[good] = ids, scores
    return rows, out, s


def _descend(x, near, found) -> int:
    """One round of NN-descent; how many neighbours the lists have taken in."""
    n, degree = near.shape
    own = np.repeat(np.arange(n, dtype=np.int32), min(MET, degree))
    other, score = near[:, :MET].ravel(), found[:, :MET].ravel()
    own, other, score = own[other >= 0], other[other >= 0], score[other >= 0]
    _, members, _ = _padded(np.concatenate([own, other]), np.concatenate([other, own]), np.concatenate([score, score]), MET)
    told, taken = [], 0

    def hand_over():
        at, more, s = _padded(*(np.concatenate(c) for c in zip(*told, strict=True)), degree)
        told.clear()
        return _take_in(near, found, at, more, s)

    for a in range(0, len(members), ROWS):
        m = members[a : a + ROWS]
        y, none = x[m], m < 0
        s = y @ y.transpose(0, 2, 1)
        s[:, np.arange(m.shape[1]), np.arange(m.shape[1])] = -np.inf
        s[none[:, :, None] | none[:, None, :] | (s <= found[m, -1][:, :, None])] = -np.inf
        top = np.argpartition(-s, TOLD - 1, axis=2)[:, :, :TOLD]
        best = np.take_along_axis(s, top, 2)
        good = np.isfinite(best)
        told.append((np.broadcast_to(m[:, :, None], best.shape)[good], np.take_along_axis(np.broadcast_to(m[:, None, :], s.shape), top, 2)[good], best[good]))
        if sum(len(t[0]) for t in told) > HELD:
            taken += hand_over()
    return taken + (hand_over() if told else 0)


def budget(n: int) -> tuple[int, int, int]:
    """Search list, expansions in a round and longest nodes to start from, for n nodes."""
    grown = max(1.0, n / SMALL) ** 0.5
    return tuple(int(np.ceil(x * grown)) for x in (LIST, EXPAND, LONGEST))


def walk(queries: DataFrame, nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """queries: q, vec, entry (a node).  q, ids, scores: the best nodes found, best first; a cut table."""
    spark = queries.sparkSession
    parts, n = int(spark.conf.get("spark.sql.shuffle.partitions")), nodes.count()
    blocks, folder = _blocks(n), fresh(spark, "ann-blocks")

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_block(batch[0].to_numpy(), blocks)), *batch.columns], ["block", "node", "vec", "ids"])

    def write(batches):
        """Each block to a file of its own, which a task that runs again puts there again."""
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(folder)
        store.create_dir(where, recursive=True)
        for block, rows in _by_block(batches):
            vectors = rows.filter(pa.compute.is_valid(rows["vec"])).sort_by("node")
            lists = rows.filter(pa.compute.is_valid(rows["ids"])).sort_by("node")
            ids = vectors["node"].to_numpy()
            x = _flat(vectors["vec"].combine_chunks(), "<f8")[0].reshape(len(ids), -1)
            other, sizes = _flat(lists["ids"].combine_chunks(), "<i8")
            near = np.full((len(ids), max(1, int(sizes.max(initial=0)))), -1, np.int32)
            rank = np.arange(len(other)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.minimum(np.searchsorted(ids, other), len(ids) - 1)
            near[np.repeat(np.searchsorted(ids, lists["node"].to_numpy()), sizes), rank] = np.where(ids[at] == other, at, -1)
            own = f"{where}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                for part in (ids, near, x):
                    held = io.BytesIO()
                    np.save(held, part)
                    out.write(held.getbuffer())
            store.move(own, f"{where}/{block}")
            yield pa.RecordBatch.from_pydict({"block": [block], "n": [len(ids)]}, schema=pa.schema([("block", pa.int64()), ("n", pa.int64())]))

    both = nodes.select("node", "vec", F.lit(None).cast("binary").alias("ids")).unionByName(graph.select("node", F.lit(None).cast("binary").alias("vec"), "ids"))
    dealt = both.mapInArrow(place, "block long, node long, vec binary, ids binary").repartition(parts, "block").sortWithinPartitions("block")
    written = cut(dealt.mapInArrow(frugal(write), "block long, n long"), "ann-written")
    there = sorted(r["block"] for r in written.collect())
    most = budget(n)[0]

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= SLICE:
                yield from walked(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from walked(pa.Table.from_batches(held))

    def walked(table):
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(folder)
        q, entry = table["q"].to_numpy(), table["entry"].to_numpy()
        v = _flat(table["vec"].combine_chunks(), "<f8")[0].reshape(len(q), -1)
        best = [(np.empty(0, np.int64), np.empty(0))] * len(q)
        for block in there:
            with store.open_input_file(f"{where}/{block}") as file:
                data = io.BytesIO(file.read())
            ids, near, x = np.load(data), np.load(data), np.load(data)
            for a in range(0, len(q), TOGETHER):
                for k, (found, scores) in enumerate(through(v[a : a + TOGETHER], entry[a : a + TOGETHER], ids, near, x), a):
                    best[k] = _best(np.concatenate([best[k][0], found]), np.concatenate([best[k][1], scores]), most)
        for a in range(0, len(q), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(q[a : a + ROWS]), pa.array([i.tolist() for i, _ in best[a : a + ROWS]], pa.list_(pa.int64())), pa.array([s.tolist() for _, s in best[a : a + ROWS]], pa.list_(pa.float64()))], ["q", "ids", "scores"])

    dealt = queries.select("q", "vec", "entry").repartition(parts, "q")
    out = cut(dealt.mapInArrow(frugal(run), "q long, ids array<long>, scores array<double>"), "ann-found")
    forget(written)
    remove(spark, folder)
    return out


def through(v, entry, ids, near, x):
    """Walk a block's graph with some queries: for each of them ids and scores of the best nodes."""
    queries, n = len(v), len(ids)
    keep, expand, starts = budget(n)
    keep = min(keep, n)
    # A state's lists: nodes by their place in the block, -1 for none.
    node, score, done = np.full((queries, keep), -1), np.full((queries, keep), -np.inf), np.ones((queries, keep), bool)
    seen = np.zeros(queries * n, bool)

    def take(rows, places):
        """Score what a query hasn't seen, and keep the best."""
        nonlocal node, score, done
        key = rows * n + places
        key = np.unique(key[~seen[key]])
        seen[key] = True
        rows, places = np.divmod(key, n)
        old = node >= 0
        row = np.concatenate([np.nonzero(old)[0], rows])
        places = np.concatenate([node[old], places])
        scores = np.concatenate([score[old], np.einsum("ij,ij->i", x[places[old.sum() :]], v[rows])])
        closed = np.concatenate([done[old], np.zeros(len(rows), bool)])
        order = np.lexsort((places, -scores, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(queries))[row]
        order, row, rank = order[rank < keep], row[rank < keep], rank[rank < keep]
        node, score, done = np.full((queries, keep), -1), np.full((queries, keep), -np.inf), np.ones((queries, keep), bool)
        node[row, rank], score[row, rank], done[row, rank] = places[order], scores[order], closed[order]

    every = np.arange(queries)
    at = np.minimum(np.searchsorted(ids, entry), n - 1)
    own = ids[at] == entry
    some = np.arange(0, n, max(1, int(n**0.5 / 4)))
    length = (x**2).sum(axis=1)
    longest = np.lexsort((ids, -length))[:starts]
    # Nodes that are longer than a query can have a larger product with it than any near its own place.
    short = every[(v**2).sum(axis=1) < 0.98 * length[longest[0]]]
    take(np.concatenate([every[own], np.repeat(every, len(some)), np.repeat(short, len(longest))]), np.concatenate([at[own], np.tile(some, queries), np.tile(longest, len(short))]))
    # Ends by itself: a round expands an open node of each query that has one, and what left a full list can't come back.
    while not done.all():
        open_ = ~done & (np.cumsum(~done, axis=1) <= expand)
        rows, places = np.nonzero(open_)[0], near[node[open_]]
        done |= open_
        rows = np.repeat(rows, places.shape[1])[places.ravel() >= 0]
        take(rows, places[places >= 0].astype(np.int64))
    for k in range(queries):
        there = node[k] >= 0
        yield ids[node[k][there]], score[k][there]


def _f8(x) -> bytes:
    return np.ascontiguousarray(x, "<f8").tobytes()


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def exact(queries: DataFrame, table: DataFrame, k: int, at_once: int = 512) -> DataFrame:
    """queries: q, vec; table: id, vec.  The k best of all rows but the query's own (id = q), compared in blocks of queries."""
    parts = []
    rows = queries.orderBy("q").select("q", "vec").toLocalIterator()
    block: list = []

    def compare(block):
        names, x = np.array([q for q, _ in block]), np.stack([np.frombuffer(v) for _, v in block])

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, y = batch[0].to_numpy(), np.frombuffer(b"".join(batch[1].to_pylist())).reshape(batch.num_rows, -1)
                s = x @ y.T
                out = [[], [], []]
                for q, row in zip(names, s, strict=True):
                    near, found = _best(ids, row, k, q)
                    out[0] += [q] * len(near)
                    out[1].append(near)
                    out[2].append(found)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(np.concatenate(out[1])), pa.array(np.concatenate(out[2]))], ["q", "vec_id", "score"])

        return table.select("id", "vec").mapInArrow(run, "q long, vec_id long, score double")

    for r in rows:
        block.append((r["q"], bytes(r["vec"])))
        if len(block) == at_once:
            parts.append(compare(block))
            block = []
    if block:
        parts.append(compare(block))
    if not parts:
        return table.select(F.col("id").alias("q"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def search(table: DataFrame, every: int, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest rows of every row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    rows = vectors(table, id_col, vec_col)
    nodes, graph = build(rows)
    # Of a vector's copies, the k + 1 smallest ids can be in a result.
    copy = Window.partitionBy("node").orderBy("id")
    members = rows.join(nodes.select("node", "vec"), "vec").select("node", "id")
    smallest = cut(members.withColumn("c", F.row_number().over(copy)).filter(F.col("c") <= k + 1).select("node", "id"), "ann-members")
    asked = cut(members.filter(F.pmod("id", F.lit(every)) == 0).select("node", F.col("id").alias("query_id")), "ann-queries")
    entries = asked.select("node").distinct().join(nodes.select("node", "vec"), "node")
    found = walk(entries.select(F.col("node").alias("q"), "vec", F.col("node").alias("entry")), nodes, graph)
    # The query's own node belongs to its candidates for the sake of its copies.
    own = entries.select(F.col("node").alias("q"), F.col("node"), F.lit(None).cast("double").alias("score"))
    pairs = found.select("q", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select("q", F.col("p.ids").alias("node"), F.col("p.scores").alias("score"))
    have = pairs.filter("node <> q").groupBy("q").agg(F.count("*").alias("n"))
    short = entries.select(F.col("node").alias("q"), "vec").join(have, "q", "left").filter(F.coalesce("n", F.lit(0)) < min(k, nodes.count() - 1)).select("q", "vec")
    short = cut(short, "ann-short")
    if not short.isEmpty():
        rest = exact(short, nodes.select(F.col("node").alias("id"), "vec"), k)
        pairs = pairs.unionByName(rest.select("q", F.col("vec_id").alias("node"), "score")).groupBy("q", "node").agg(F.max("score").alias("score"))
    pairs = pairs.filter("node <> q").unionByName(own)
    itself = entries.select(F.col("node").alias("q"), "vec").mapInArrow(_itself, "q long, self double")
    pairs = pairs.join(itself, "q").select("q", "node", F.coalesce("score", "self").alias("score"))
    best_nodes = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    pairs = pairs.withColumn("b", F.row_number().over(best_nodes)).filter(F.col("b") <= k + 1)
    # One list for all queries of a node: without the query itself, k of k + 1 are left.
    best_ids = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    lists = pairs.join(smallest, "node").withColumn("b", F.row_number().over(best_ids)).filter(F.col("b") <= k + 1).select("q", "id", "score")
    candidates = asked.withColumnRenamed("node", "q").join(lists, "q").filter("id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return candidates.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _itself(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch[0], pa.array([float((np.frombuffer(v) ** 2).sum()) for v in batch[1].to_pylist()], pa.float64())], ["q", "self"])
