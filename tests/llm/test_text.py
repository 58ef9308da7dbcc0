import hashlib
import random
import zlib

import numpy as np
import pytest
from tessaphon.llm import chat, licenses, linededup, media, packing, registry, sentencepiece_fst, sharding, word_bpe
from tessaphon.llm.common import cut

sentencepiece = pytest.importorskip("sentencepiece")
PIECES = "doc_id long, text string"


@pytest.fixture(scope="module")
def model():
    return registry.tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def word_file():
    return registry.tokenizer_file("word_bpe_49k.json")


BITS = ["a", "b", "e", "th", "in", " ", "  ", "   ", "    ", "▁", "\n", "\t", "é", "梦", "😀", "\x00", "the", "<s>", "<0x0A>", "1", "12", ".", "،", "ла", "Z", "ing"]


def some_texts(seed, n, longest=14):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randrange(longest))) for _ in range(n)]


def test_sentencepiece_equals_the_library(model):
    ours, lib = sentencepiece_fst.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in some_texts(1, 4000) + ["x" * 3000, " ".join(some_texts(2, 300))]:
        ids = np.frombuffer(ours.encode(text), "<i4").tolist()
        assert ids == lib.encode(text)
        assert ours.decode(ids) == lib.decode(ids)


def test_unigram_is_the_best_segmentation():
    from itertools import combinations

    from tessaphon.llm.wfst import UnigramTransducer

    scores = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -2.2, "aba": -5.5, "bb": -4.0}
    machine = UnigramTransducer(scores, 20.0)
    cost = lambda p: sum(-scores[x] if x in scores else 20.0 if len(x) == 1 else 1e9 for x in p)
    for k in range(1, 200):
        text = bin(k)[2:].replace("0", "a").replace("1", "b").replace("bbb", "bxb")
        cuts = [[text[i:j] for i, j in zip((0, *c), (*c, len(text)), strict=True)] for n in range(len(text)) for c in combinations(range(1, len(text)), n)]
        assert cost(machine.shortest(text)) == pytest.approx(min(map(cost, cuts)))


def test_sentencepiece_tables(spark, model):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Hello wörld"), (3, "Hello wörld"), (None, "x")], PIECES)
    out = sentencepiece_fst.decode(sentencepiece_fst.encode(df, model), model)
    assert sorted((x.doc_id or 0, len(x.ids) > 0, x.text) for x in out.collect()) == [(0, True, "x"), (1, False, ""), (2, False, ""), (3, True, "Hello wörld"), (3, True, "Hello wörld")]
    assert sentencepiece_fst.encode(df.limit(0), model).count() == 0


def test_word_ids_equal_the_library(word_file):
    ours = word_bpe.WordTokenizer(word_file)
    extra = ["Hello, World!", "it's", "ÀÉß naïve", "é", "<|endoftext|> x", "ΑΣ σ", "İx", "a_b 12a", "x\x1cy"]
    for text in some_texts(3, 1500) + extra:
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == ours.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    r, capacity = np.random.default_rng(seed), 200
    lengths = np.minimum(capacity, 1 + r.lognormal(3.5, 1, 400).astype(int)) if seed % 2 else r.integers(1, capacity + 1, 300)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    held, seen = {}, set()
    for length, first, n, base, per, _ in packing.plan_sequences(counts, capacity, groups=16):
        for k in range(n):
            held.setdefault(base + k // per, []).append(length)
            seen.add((length, first + k))
    assert seen == {(length, k) for length, n in counts.items() for k in range(n)}
    assert sum(map(len, held.values())) == len(lengths) and max(map(sum, held.values())) <= capacity
    first_fit = []
    for x in sorted(lengths, reverse=True):
        for k, room in enumerate(first_fit):
            if room >= x:
                first_fit[k] -= x
                break
        else:
            first_fit.append(capacity - x)
    assert len(held) <= 1.03 * len(first_fit) + 1


def test_packing(spark, word_file):
    docs = [(k, "word " * (37 * k % 90)) for k in range(60)] + [(None, "null id"), (7, None), (7, None)]
    df = spark.createDataFrame(docs, PIECES).selectExpr("*", "1 as length", "2 as rank")
    rows = packing.pack(cut(packing.pieces(df, word_file, 64, 1), "t"), 64).collect()
    tok = word_bpe.WordTokenizer(word_file)
    want = sorted((d or -1, zlib.crc32(ids[4 * s : 4 * (s + 64)]), s) for d, t in docs for ids in [tok.ids(t or "") + b"\1\0\0\0"] for s in range(0, len(ids) // 4, 64))
    assert sorted((-1 if x.doc_id is None else x.doc_id or -1, x.ids_crc32, x.start) for x in rows) == want
    held = {}
    for x in rows:
        held.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(cut(packing.pieces(df.limit(0), word_file, 64, 1), "t"), 64).count() == 0


def test_escape():
    r = random.Random(4)
    parts = [*chat.CONTROLS, "\\", "<", "[", "s>", "/s>", "x", "\n", "<\\s>"]
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "a\nb\\n", ""]), "".join(r.choice(parts) for _ in range(r.randrange(6)))) for _ in range(r.randrange(4))]
        text, spans = chat.format_turns(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for role, t in turns if role == "assistant"]
        assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROLS)


def test_reply_trees(spark):
    r, rows, trees = random.Random(5), [], {}
    for t in range(6):
        trees[t] = {k: (None if k == 0 else k - 1 if t % 3 == 0 else r.randrange(k)) for k in range(r.randrange(1, 20))}
        rows += [(t, k, p, r.choice([None, 0.5, 2.0]), r.choice(["user", "assistant", None]), r.choice(["a", "</s>", None])) for k, p in trees[t].items()]
    value, want = {(x[0], x[1]): x for x in rows}, {}
    rows += [(99, 1, 2, 1.0, "user", "x"), (99, 2, 1, 1.0, "user", "y"), (98, 5, 777, 1.0, "user", "z"), (None, 1, None, 1.0, "user", "n")]
    for t, parents in trees.items():
        paths = []
        for leaf in set(parents) - set(parents.values()):
            path = [leaf]
            while parents[path[-1]] is not None:
                path.append(parents[path[-1]])
            paths.append((-sum(value[t, k][3] or 0 for k in path) / len(path), leaf, [(value[t, k][4] or "", value[t, k][5] or "") for k in reversed(path)]))
        want |= {(t, n): (leaf, turns) for n, (_, leaf, turns) in enumerate(sorted(paths)[:2], 1)}
    want |= {(98, 1): (5, [("user", "z")]), (None, 1): (1, [("user", "n")])}
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    assert {(x.tree, x["rank"]): (x.leaf, chat.parse(x.formatted)) for x in chat.conversations(df, 2).collect()} == want


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>"), (2, 0, None, None), (1, 1, "assistant", "</s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x.tree: x for x in chat.read_back(chat.conversations(chat.chains(df)), "tree").collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 8 and got[1].loss_sha256 == hashlib.sha256(b"</s></s>").hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest() and got[2].loss_chars == 0


def test_sharding(spark):
    rows = [(k, "x" * (k % 17)) for k in range(400)] + [(5, "y" * 9)] * 60 + [(None, None), (900, "z" * 500)]
    out = sharding.shard(spark.createDataFrame(rows, PIECES), 100).collect()
    assert sorted((x.doc_id is None, x.doc_id, x.n_bytes) for x in out) == sorted((k is None, k, len(t or "")) for k, t in rows)
    size = {}
    for x in out:
        size[x.shard] = size.get(x.shard, 0) + x.n_bytes
    assert all(n <= 100 or s.startswith("big-") for s, n in size.items())
    names = [s for s in size if not s.startswith("big-")]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    # Only oversized buckets split: each shard's parent is too large.
    for s in names:
        assert not s or sum(n for t, n in size.items() if t.startswith(s[:-1])) > 100
    assert sharding.shard(spark.createDataFrame([], PIECES), 100).count() == 0


def test_licenses(spark):
    mit = licenses.SENTENCES
    text = f"Title. {mit['MIT_GRANT'].upper()}:\n{mit['MIT_NOTICE']}. Other!\nAll rights reserved."
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Licensed under the  Apache License, Version 2.0.\nReleased under the MIT License.")], PIECES)
    got = {x.doc_id: (x.sentence_ids, x.licenses, x.n_unused) for x in licenses.scan(df).collect()}
    assert got == {1: ("MIT_GRANT,MIT_NOTICE,ALL_RIGHTS", "MIT,Proprietary", 0), 2: ("", "", 0), 3: ("", "", 0), 4: ("APACHE_NAME,MIT_NAME", "Apache-2.0,MIT", 0)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_dedup(spark):
    from pyspark.sql import functions as F

    r, letters = random.Random(1), "abcdé😀 "

    def changed(s, k):
        s = list(s)
        for _ in range(k):
            i = r.randrange(len(s) + 1)
            s[i : i + r.randrange(2)] = r.choice(["", r.choice(letters)])
        return "".join(s)

    base = ["".join(r.choice(letters) for _ in range(r.randrange(18, 40))) for _ in range(40)]
    lines = base + [changed(r.choice(base), r.randrange(5)) for _ in range(160)]
    pairs = spark.createDataFrame([(a, b) for a in lines[:60] for b in lines[40:100]], "a string, b string")
    assert all(x.n == (edits(x.a, x.b) <= 2) for x in pairs.select("a", "b", linededup.near(F.col("a"), F.col("b")).alias("n")).collect())
    docs = [(k, "\n".join(lines[5 * k : 5 * k + 5])) for k in range(40)]
    first, want = {}, {}
    for k, t in docs:
        for n, x in enumerate(t.split("\n")):
            first.setdefault(x, (k, n))
    for k, t in docs:
        keep = [x for n, x in enumerate(t.split("\n")) if len(x) < 20 or (first[x] == (k, n) and not any(len(y) >= 20 and first[y] < first[x] and edits(x, y) <= 2 for y in first))]
        want[k] = "\n".join(keep)
    more = [(60, None), (61, ""), (None, lines[0]), docs[3]]
    got = {}
    for x in linededup.dedup(spark.createDataFrame(docs + more, PIECES).selectExpr("*", "text as gone", "doc_id as doc")).collect():
        got.setdefault(x.doc_id, []).append(x.text)
    assert {k: got[k][0] for k in want} == want
    assert (got[60], got[61], got[None], got[3]) == ([None], [""], [lines[0]], [want[3]] * 2)
    assert linededup.dedup(spark.createDataFrame([], PIECES)).count() == 0


def test_media(spark, tmp_path):
    docs = [(1, "héllo"), (2, None), (3, "a" * 192), (4, "b" * 193), (None, "héllo"), (1, "héllo")]
    folder = media.store(spark.createDataFrame(docs, PIECES), "doc_id", "text")
    got = media.features(media.read(spark, folder, range_bytes=100)).collect()
    want = sorted((k or 0, len((t or "").encode()), hashlib.sha256(media.padded((t or "").encode())).hexdigest()) for k, t in docs)
    assert sorted((x.id or 0, x.n_bytes, x.payload_sha256) for x in got) == want
    assert {x.id: x.payload_bytes for x in got if x.id} == {1: 192, 2: 192, 3: 192, 4: 384}
    assert len({(x.media_sha256, x.feature) for x in got if x.n_bytes == 6}) == 1
    empty = media.store(spark.createDataFrame([], PIECES), "doc_id", "text")
    assert media.read(spark, empty).count() == 0


def test_media_retries(spark, monkeypatch):
    from urllib.parse import urlparse

    folder = media.store(spark.createDataFrame([(k, f"text {k}") for k in range(5)], PIECES).coalesce(1), "doc_id", "text")
    reader = media.MediaReader({"path": folder, "attempts": "3"})
    part, failed, read = reader.partitions()[0], [], media.MediaReader.member

    def flaky(self, archive, info, file=None):
        if info.header_offset and len(failed) < 2:
            failed.append(info.header_offset)
            raise OSError("gone")
        return read(self, archive, info, file)

    monkeypatch.setattr(media.MediaReader, "member", flaky)
    assert sum(b.num_rows for b in reader.read(part)) == 5 and len(set(failed)) == 1
    monkeypatch.undo()
    path = urlparse(folder).path + "/" + part.archive.rpartition("/")[2]
    data = bytearray(open(path, "rb").read())
    data[80] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(ValueError, match="checksum"):
        list(reader.read(part))
    rows = [r for b in media.MediaReader({"path": folder, "on_error": "null", "attempts": "2"}).read(part) for r in b.to_pylist()]
    assert [r["error"] is None for r in rows] == [False, True, True, True, True]
