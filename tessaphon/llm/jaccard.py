"""Similarity join on word n-grams, with Bayesian pruning of candidates.

Texts are compared as sets of five-word shingles of their lower-cased words.
Documents with the same words are one node, so copies cost nothing further.

Candidates share one of 50 bands of five MinHash values, which a pair at the
threshold of 0.8 misses once in 4e8.  Pairs are never listed: nodes that share
a band get the smallest label among their band mates, nodes of a label are
dealt into blocks of about 256, and what is listed is pairs of blocks (tiles)
that share a band; a block goes to its tiles as one row.  A tile compares its nodes' MinHash values step by step and
drops a pair when the posterior probability (uniform prior) that its similarity
reaches the threshold falls below the tolerance.  Nodes with a pair left have
their shingle sets compared exactly, again by tile.  A pair of nodes lies in
one tile, so links can be counted where they are found; a tile returns counts
for its nodes and a spanning forest of its links.

Defined cases: a text of fewer words than a shingle is one shingle; a null or
empty text, or one without words, is its own class without links; a null id has
a null class and no links; repeated rows are copies of each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, frugal, join_checked
from .wfst import Memo

WORDS, THRESHOLD, BANDS, ROWS, COMPARED, STEP, TOLERANCE, BLOCK = 5, 0.8, 50, 5, 64, 16, 1e-6, 256
#: Blocks in a batch between the JVM and Python.
BLOCK_ROWS = 50
_WORD = re.compile(r"[^\W_]+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_factors = (np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_memo():
    import xxhash

    return Memo(lambda w: xxhash.xxh64_intdigest(w), 300_000)


def shingles(found: list[str], memo) -> np.ndarray:
    """The distinct shingles of a list of words, as sorted 64-bit hashes."""
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    size = min(WORDS, len(found))
    x = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        x = x * _PRIME + h[k : len(h) - size + 1 + k]
    return np.unique(_mix(x))


def minhash(x: np.ndarray) -> np.ndarray:
    """BANDS * ROWS MinHash values (32 bits)."""
    out = np.full(len(_factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 2048):
        np.minimum(out, (x[at : at + 2048] * _factors[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def bands(signature: np.ndarray) -> np.ndarray:
    x = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in signature.reshape(BANDS, ROWS).T:
        x = _mix(x * _PRIME + column)
    return x.view(np.int64)


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of compared values: the least number of matches that keeps a pair.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in range(STEP, COMPARED + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def profiles(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key (of the words), n shingles, bands, sig."""

    def run(batches):
        import hashlib

        memo = _word_memo()
        for batch in batches:
            keys, sizes, held, sigs = [], [], [], []
            for text in batch[1]:
                found = words(text.as_py() or "")
                x = shingles(found, memo)
                keys.append(hashlib.blake2b(" ".join(found).encode(), digest_size=16).hexdigest() if found else None)
                sizes.append(len(x))
                if len(x):
                    sig = minhash(x)
                    held.append(bands(sig))
                    sigs.append(sig[:COMPARED].tobytes())
                else:
                    held.append(None)
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(keys, pa.string()), pa.array(sizes, pa.int32()), pa.array(held, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], ["id", "key", "n", "bands", "sig"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(frugal(run), "id long, key string, n int, bands array<long>, sig binary")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node, wanted, copies, text to node, key, copies, set (sorted 64-bit hashes, little-endian), where the text has the wanted key."""

    def run(batches):
        import hashlib

        memo = _word_memo()
        for batch in batches:
            rows, sets = [], []
            for i, (wanted, text) in enumerate(zip(batch[1].to_pylist(), batch[3], strict=True)):
                found = words(text.as_py() or "")
                if hashlib.blake2b(" ".join(found).encode(), digest_size=16).hexdigest() == wanted:
                    rows.append(i)
                    sets.append(shingles(found, memo).tobytes())
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in batch.columns[:3]), pa.array(sets, pa.binary())], ["node", "key", "copies", "set"])

    return texts.select("node", "wanted", "copies", "text").mapInArrow(frugal(run), "node long, key string, copies long, set binary")


def _by_tile(batches):
    """Groups of rows of equal tile (column 0) from batches sorted by it, as record batches."""
    held, last = [], None
    for batch in batches:
        tiles = batch[0].to_numpy()
        if not len(tiles):
            continue
        edges = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
        for a, b in zip(edges, edges[1:], strict=False):
            if held and tiles[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tiles[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sides(table):
    """Row numbers of both sides; the same array twice in a tile of one block."""
    side = table["side"].to_numpy()
    left, right = np.flatnonzero(side <= 1), np.flatnonzero(side == 2)
    return (left, right) if len(right) else (left, left)


def _unpacked(table):
    """A row for each member."""
    lists = table["members"].combine_chunks()
    of, members = pa.compute.list_parent_indices(lists), lists.flatten()
    return table.select(["tile", "side"]).take(of).append_column("node", members.field("node")).append_column("sig", members.field("sig"))


def _prune(batches):
    """tile, side, members (node, sig): tile, side, node of those that have a pair left after pruning."""
    least = least_matches(THRESHOLD, TOLERANCE)
    for table in map(_unpacked, _by_tile(batches)):
        left, right = _sides(table)
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, COMPARED)
        i, j = np.triu_indices(len(left), 1) if left is right else (x.ravel() for x in np.indices((len(left), len(right))))
        i, j, matches = left[i], right[j], np.zeros(len(i), np.int32)
        for n, m in least.items():
            matches += (sig[i, n - STEP : n] == sig[j, n - STEP : n]).sum(axis=1, dtype=np.int32)
            stay = matches >= m
            i, j, matches = i[stay], j[stay], matches[stay]
        if len(i):
            stay = np.unique(np.concatenate([i, j]))
            yield from table.select(["tile", "side", "node"]).take(stay).to_batches()


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left and right sets."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[code] > 1
    code, owner = code[shared], owner[shared]
    _, code = np.unique(code, return_inverse=True)
    width = int(code.max()) + 1 if len(code) else 0
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    for start in range(0, width, 4096):
        a, b = np.searchsorted(code, [start, start + 4096])
        dense = np.zeros((len(sets), min(4096, width - start)), np.float32)
        dense[owner[a:b], code[a:b] - start] = 1
        out += dense[left] @ dense[right].T
    return out.astype(np.int64)


def _verify(batches):
    """tile, side, key, copies, set: links of each node, and a spanning forest of the links."""
    for table in _by_tile(batches):
        left, right = _sides(table)
        keys, copies = table["key"].to_pylist(), table["copies"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        size = np.array([len(s) for s in sets])
        both = overlaps(sets, left, right)
        # A similarity of at least 4/5, in whole numbers.
        linked = 5 * both >= 4 * (size[left][:, None] + size[right][None, :] - both)
        if left is right:
            np.fill_diagonal(linked, False)
        texts, docs = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        texts[left] = linked.sum(axis=1)
        docs[left] = linked @ copies[right]
        if left is not right:
            texts[right] = linked.sum(axis=0)
            docs[right] = linked.T @ copies[left]
        root = list(range(len(keys)))

        def top(k, root=root):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for a, b in zip(*np.nonzero(linked), strict=True):
            a, b = sorted((top(int(left[a])), top(int(right[b]))), key=lambda k: keys[k])
            root[b] = a
        some = np.flatnonzero(texts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in some], pa.string()), pa.array([keys[top(int(k))] for k in some], pa.string()), pa.array(texts[some]), pa.array(docs[some])], ["key", "root", "texts", "docs"])


def components(edges: DataFrame) -> DataFrame:
    """key, root (edges, cut) to key, label: the smallest key that can be reached."""
    both = cut(edges.select("key", F.col("root").alias("other")).unionByName(edges.select(F.col("root").alias("key"), F.col("key").alias("other"))).filter("key <> other").distinct(), "cc-edges")
    labels = cut(both.groupBy("key").agg(F.min("other").alias("other")).select("key", F.least("key", "other").alias("label")), "cc-labels")
    while True:
        near = both.join(labels.withColumnRenamed("key", "other"), "other").groupBy("key").agg(F.min("label").alias("near"))
        hooked = cut(labels.join(near, "key").select("key", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "cc-labels")
        jump = hooked.select(F.col("key").alias("label"), F.col("label").alias("further"))
        jumped = cut(hooked.join(jump, "label", "left").select("key", F.least("label", F.coalesce("further", "label")).alias("label"), "moved"), "cc-labels")
        forget(hooked, labels)
        labels = jumped
        if labels.filter("moved").isEmpty():
            forget(both)
            return labels.select("key", "label")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, class_id (the smallest id of its class), n_links, n_copies.

    n_links counts the other documents with a similarity of 0.8 or more; n_copies
    those among them with the same words.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    profiled = cut(profiles(docs, id_col, text_col), "jaccard-profiles")
    own = F.col("id").isNotNull() & F.col("key").isNotNull()
    rows = cut(profiled.select("id", "key"), "jaccard-rows")
    copies = cut(rows.filter(own).groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("copies")), "jaccard-copies")
    # Nodes go by 64 bits of their key until sets are compared; two of equal bits only meet once more.
    node = F.xxhash64("key").alias("node")
    posted = profiled.filter(own).select(node, "bands").dropDuplicates(["node", "bands"]).select(F.explode("bands").alias("band"), "node")
    # Most bands have one node: only what two share is asked for its smallest one.
    several = posted.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1").select("band")
    met = cut(posted.join(several, "band"), "jaccard-met")
    lows = met.groupBy("band").agg(F.min("node").alias("low"))
    labels = cut(met.join(lows, "band").groupBy("node").agg(F.min("low").alias("label"), F.collect_set("band").alias("bands")), "jaccard-labels")
    forget(met)
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    blocks = cut(labels.join(sizes, "label").select("node", "bands", F.xxhash64("label", F.pmod(F.xxhash64(F.lit("block"), "node"), F.ceil(F.col("size") / BLOCK))).alias("block")), "jaccard-blocks")
    held = cut(blocks.select(F.explode("bands").alias("band"), "block").distinct(), "jaccard-bands")
    forget(labels)
    tiles = held.select("band", F.col("block").alias("b1")).join(held.select("band", F.col("block").alias("b2")), "band").filter("b1 <= b2").select("b1", "b2").distinct()
    tiles = cut(tiles.select("b1", "b2", F.xxhash64("b1", "b2").alias("tile")), "jaccard-tiles")
    forget(held)
    first = tiles.select("tile", F.col("b1").alias("block"), F.lit(1).alias("side"))
    second = tiles.filter("b1 <> b2").select("tile", F.col("b2").alias("block"), F.lit(2).alias("side"))
    # A block travels to its tiles as one row; a node's values travel once, to where it joins its block.
    sigs = profiled.filter(own).groupBy(node).agg(F.collect_set("sig").alias("sigs"))
    members = blocks.select("node", "block").join(sigs, "node").select("node", "block", F.explode("sigs").alias("sig")).groupBy("block").agg(F.collect_list(F.struct("node", "sig")).alias("members"))
    tiled = first.unionByName(second).join(members, "block").select("tile", "side", "members").repartition(parts, "tile").sortWithinPartitions("tile")
    left = cut(tiled.mapInArrow(frugal(_prune), "tile long, side int, node long"), "jaccard-left", BLOCK_ROWS)
    forget(profiled, tiles, blocks)
    wanted = cut(left.select("node").distinct().join(copies.select(node, "key", "first", "copies"), "node").select("node", "first", F.col("key").alias("wanted"), "copies"), "jaccard-wanted")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = join_checked(base, wanted, F.col("id") == F.col("first")).select("node", "wanted", "copies", "text")
    # Sets travel twice: by node, where repeated rows of a node's first document fall together, and by tile.
    sets = shingle_sets(texts).repartition(parts, "node").dropDuplicates(["node", "key"])
    full = left.distinct().join(sets, "node").select("tile", "side", "key", "copies", "set").repartition(parts, "tile").sortWithinPartitions("tile")
    found = cut(full.mapInArrow(frugal(_verify), "key string, root string, texts long, docs long"), "jaccard-links")
    forget(left, wanted)
    links = found.groupBy("key").agg(F.sum("docs").alias("links"))
    classes = components(found.select("key", "root")).join(copies.select("key", "first"), "key")
    least = classes.groupBy("label").agg(F.min("first").alias("class"))
    known = cut(classes.join(least, "label").join(links, "key", "left").select("key", "class", F.coalesce("links", F.lit(0)).alias("links")), "jaccard-classes")
    out = rows.select("id", "key").join(copies, "key", "left").join(known, "key", "left")
    alone = F.col("id").isNull() | F.col("key").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.coalesce("class", "first")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1).alias("n_copies"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each class, with its own columns; one row of it where its id is repeated."""
    name = "class_" + uuid.uuid4().hex
    joined = join(docs)
    gone = joined.filter("doc_id is not null and class_id <> doc_id").select("doc_id")
    twice = joined.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_copies").alias("c")).filter("n > 1 and c > 0").select("doc_id")
    gone, twice = cut(gone.distinct().withColumnRenamed("doc_id", name), "jaccard-gone"), cut(twice.withColumnRenamed("doc_id", name), "jaccard-twice")
    stay = join_checked(docs, gone, docs["doc_id"] == F.col(name), "left_anti")
    if twice.isEmpty():
        return stay
    once = join_checked(stay, twice, stay["doc_id"] == F.col(name), "left_semi").dropDuplicates(["doc_id", "text"])
    return join_checked(stay, twice, stay["doc_id"] == F.col(name), "left_anti").unionByName(once)


def oracle(table: str = "documents") -> str:
    """The same in DuckDB, from the pairs of texts that share a shingle."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS ws FROM {table}),
k AS (SELECT doc_id, array_to_string(ws, ' ') AS key, ws FROM w),
c AS (SELECT key, min(doc_id) AS first, count(*) AS copies, any_value(ws) AS ws FROM k WHERE key <> '' GROUP BY key),
s AS (SELECT DISTINCT first, copies, unnest(CASE WHEN len(ws) < {WORDS} THEN [key] ELSE list_transform(range(1, len(ws) - {WORDS} + 2), lambda i: array_to_string(ws[i:i + {WORDS} - 1], ' ')) END) AS g FROM c),
n AS (SELECT first, copies, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.first AS a, b.first AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.first <> b.first GROUP BY ALL),
e AS (SELECT a, b, y.copies FROM p JOIN n x ON x.first = a JOIN n y ON y.first = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
r AS (SELECT first AS node, first AS seen FROM n UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
m AS (SELECT node, min(seen) AS class_id FROM r GROUP BY node),
l AS (SELECT a, sum(copies) AS links FROM e GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, (coalesce(links, 0) + coalesce(copies, 1) - 1)::BIGINT AS n_links, (coalesce(copies, 1) - 1)::BIGINT AS n_copies
FROM k LEFT JOIN c USING (key) LEFT JOIN m ON m.node = c.first LEFT JOIN l ON l.a = c.first"""
