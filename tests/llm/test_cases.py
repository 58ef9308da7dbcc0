"""Cases that every operator defines, and results against plain re-computations."""

import hashlib
import random
import struct
import time
import zlib
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tessaphon.llm import ann, chat, licenses, media, packing, quality, registry, sentencepiece_fst, sharding
from tessaphon.llm.common import BATCH_ROWS, cut

DOCS = "doc_id long, text string"
#: Names that operators use inside.
CLASHING = ("id", "key", "node", "q", "vec", "shard", "fine", "n", "s", "piece", "error", "archive", "lang_", "rest0", "h1", "row")


def with_clashes(df):
    return df.select("*", *(F.lit(1).alias(c) for c in CLASHING))


def test_recall_when_the_table_is_many_windows(spark, monkeypatch):
    r = np.random.default_rng(9)
    x = r.standard_normal((3000, 16)) * (0.5 + r.random((3000, 1)))
    df = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<double>")
    window = 64  # 47 windows
    build = ann.build
    monkeypatch.setattr(ann, "build", lambda rows: build(rows, window=window))
    monkeypatch.setattr(ann, "BLOCK", 200)
    got = {}
    for m in ann.search(df, 20, 20).collect():
        got.setdefault(m.query_id, set()).add(m.vec_id)
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found & set(np.argsort(-s)[:20].tolist()))
    assert len(got) == 150 and hits / (20 * 150) >= 0.95


def test_nearest_with_clashing_columns(spark):
    df = spark.createDataFrame([(k, [float(k % 7), 1.0, float(k)]) for k in range(60)], "vec_id long, embedding array<double>")
    plain = ann.search(df, 20, 5).orderBy("query_id", "rank").collect()
    assert ann.search(with_clashes(df), 20, 5).orderBy("query_id", "rank").collect() == plain and len(plain) == 15


def test_long_runs_of_spaces():
    sentencepiece = pytest.importorskip("sentencepiece")
    file = registry.tokenizer_file("piece_bpe_32k.model")
    ours, lib = sentencepiece_fst.Transducer(file), sentencepiece.SentencePieceProcessor(model_proto=file)
    for n in (1, 2, 17, 5000):
        text = f"a{' ' * n}b  c{' ' * n}"
        assert np.frombuffer(ours.encode(text), "<i4").tolist() == lib.encode(text)
    began = time.process_time()
    ours.encode("a" + " " * 100_000 + "b")
    assert time.process_time() - began < 5  # merging one by one would take ten minutes


def test_normaliser_and_fallback():
    plain, squeezed = sentencepiece_fst.normaliser(True, False), sentencepiece_fst.normaliser(True, True)
    of = lambda fst, text: "".join(fst.compose(text)[0])
    assert [of(plain, t) for t in ("", "a b", "  a ")] == ["", "▁a▁b", "▁▁▁a▁"]
    assert [of(squeezed, t) for t in ("", "   ", "a b", "  a   bc  ")] == ["", "", "▁a▁b", "▁a▁bc"]
    assert of(sentencepiece_fst.normaliser(False, True), " a  b") == "a▁b"
    machine = sentencepiece_fst.Transducer(registry.tokenizer_file("piece_bpe_32k.model"))
    ids, weight = machine.union.arc("\x7f梦"[:1])
    assert [machine.texts[k] for k in ids] == [b"\x7f"] and weight > 0


def test_tokenizer_with_clashing_columns(spark):
    file = registry.tokenizer_file("piece_bpe_32k.model")
    df = with_clashes(spark.createDataFrame([(1, "Hello  wörld"), (2, None)], DOCS))
    out = sentencepiece_fst.decode(sentencepiece_fst.encode(df, file), file)
    assert {x.doc_id: x.text for x in out.collect()} == {1: "Hello  wörld", 2: ""}


def test_chat_without_rows_and_with_clashes(spark):
    kinds = "conv_id long, turn long, role string, text string"
    none = chat.read_back(chat.conversations(chat.chains(spark.createDataFrame([], kinds))), "tree")
    assert none.count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b" * 200_000), (2, 0, None, None)], kinds)
    got = {x.tree: x.loss_chars for x in chat.read_back(chat.conversations(chat.chains(with_clashes(rows).select(*rows.columns))), "tree").collect()}
    assert got == {1: 200_000, 2: 0}


def test_shards_with_clashing_columns_and_depths(spark):
    rows = [(k, "x" * 50) for k in range(300)]
    out = sharding.shard(with_clashes(spark.createDataFrame(rows, DOCS)), 500).collect()
    assert len(out) == 300 and len({x.depth for x in out}) > 1
    big = sharding.shard(spark.createDataFrame([(1, "y" * 900), (1, "y" * 901)], DOCS), 500).collect()
    assert len({x.shard for x in big}) == 2 and {x.depth for x in big} == {-1}


def test_licences_of_no_rows_long_texts_and_clashes(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0
    text = "Nothing to see. " * 20_000 + "Released under the MIT License."
    df = with_clashes(spark.createDataFrame([(1, text), (2, "x" * 500_000)], DOCS).coalesce(1))
    assert {x.doc_id: x.licenses for x in licenses.scan(df).collect()} == {1: "MIT", 2: ""}


def features_of(text):
    """The columns of op10 by plain Python and NumPy."""
    data = text.encode()
    payload = data + b" " * (-len(data) % 192 if data else 192)
    x = np.frombuffer(payload, np.uint8).astype(float)
    power = np.zeros(97)
    for frame in x.reshape(-1, 192):
        power += [abs(sum((v - 97) * np.exp(-2j * np.pi * b * k / 192) for k, v in enumerate(frame))) ** 2 for b in range(97)]
    bands, at = [], 1
    for _ in range(8):
        bands.append(10 * np.log10(power[at : at + 12].sum() * 192 / len(x) + 1e-9))
        at += 12
    rows = b"".join(b"\0" + payload[k : k + 192] for k in range(0, len(payload), 192))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    image = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 192, len(payload) // 192, 8, 0, 0, 0, 0)) + chunk(b"naTv", struct.pack(">Q", len(data))) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")
    crossings = sum((a >= 97) != (b >= 97) for a, b in zip(x, x[1:], strict=False))
    told = f"mean={x.mean():.3f};std={x.std():.3f};cross={crossings};bands=" + ",".join(f"{b:.1f}" for b in bands)
    return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(image), hashlib.sha256(image).hexdigest(), told


def test_media_columns_by_plain_computation(spark):
    texts = ["", "héllo", "a" * 192, "The quick brown fox. " * 30, "é" * 97]
    df = with_clashes(spark.createDataFrame(list(enumerate(texts)), DOCS))
    got = media.features(media.read(spark, media.store(df, "doc_id", "text"))).collect()
    assert len(got) == len(texts)
    for x in got:
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32, x.media_bytes, x.media_sha256, x.feature) == features_of(texts[x.id])
        assert x.error is None


def archives_of(folder):
    return sorted(Path(urlparse(folder).path).glob("part-*.zip"))


def test_lost_and_cut_archives(spark):
    folder = media.store(spark.createDataFrame([(k, f"text {k}" * 40) for k in range(12)], DOCS).repartition(3), "doc_id", "text")
    first, second, third = archives_of(folder)
    whole = media.features(media.read(spark, folder)).count()
    second.unlink()
    with pytest.raises(Exception, match="archives of the manifest are missing"):
        media.read(spark, folder).count()
    # Cut to its first members: another size than the manifest's.
    third.write_bytes(third.read_bytes()[:300])
    rows = media.features(media.read(spark, folder, on_error="null")).collect()
    assert sum(x.error is not None for x in rows) == 2 and 0 < sum(x.error is None for x in rows) < whole == 12


def test_broken_headers_and_images(spark):
    folder = media.store(spark.createDataFrame([(k, f"text {k}") for k in range(4)], DOCS).coalesce(1), "doc_id", "text")
    path = archives_of(folder)[0]
    data = bytearray(path.read_bytes())
    at = data.find(b"PK\x03\x04", 30)
    data[at : at + 4] = b"XXXX"
    path.write_bytes(data)
    reader = media.MediaReader({"path": folder, "on_error": "null", "attempts": "1"})
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["error"] is None for r in rows] == [True, False, True, True]
    # No directory at the end, at the size that the manifest has.
    path.write_bytes(data[: len(data) // 2] + bytes(len(data) - len(data) // 2))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == 1 and rows[0]["media"] is None and rows[0]["error"]
    with pytest.raises(Exception):  # noqa: B017
        list(media.MediaReader({"path": folder, "attempts": "1"}).read(reader.partitions()[0]))
    image = media.to_png(b"abc")
    for wrong in (image[:20], image[:-20], b"", image[:50] + b"x" + image[51:]):
        with pytest.raises(media.BROKEN):
            media.from_png(wrong)
    members = spark.createDataFrame([("+31", bytearray(image[:20]), None), ("+32", None, "gone")], "key string, media binary, error string").withColumn("key", F.lit("1"))
    assert [x.error is not None and x.feature is None for x in media.features(members).collect()] == [True, True]


def test_first_open_is_tried_again(spark, monkeypatch):
    folder = media.store(spark.createDataFrame([(k, f"text {k}") for k in range(4)], DOCS).coalesce(1), "doc_id", "text")
    reader, opened, failed = media.MediaReader({"path": folder}), media.MediaReader.open, []

    def flaky(self, archive):
        if len(failed) < 2:
            failed.append(archive)
            raise OSError("gone")
        return opened(self, archive)

    monkeypatch.setattr(media.MediaReader, "open", flaky)
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 4 and len(failed) == 2


def test_quality_of_long_words_repeated_rows_and_no_rows(spark):
    words = ["alpha", "beta", "gamma", "delta"]
    good = [(k, " ".join(words[(k + j) % 4] for j in range(40)), "en") for k in range(40)]
    odd = [(90, "梦" * 30_000, "en"), (91, good[0][1], "en"), (92, "alpha beta " * 50_000, "en")]
    df = spark.createDataFrame(good + odd, DOCS + ", lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    judged, own = quality.judge(with_clashes(df), labels)
    got = {x.doc_id: x[own] for x in judged.collect()}
    assert got[91] == got[0] and not got[90]["keep"] and got[92]["perplexity"] is not None
    assert quality.keep_good(df.limit(0), labels.limit(0)).count() == 0
    # The pieces of a long word have its n-grams, in order.
    for n in (1, 23, 24, 25, 26, 48, 49, 100):
        word = "".join(chr(97 + k % 26) for k in range(n))
        assert [g for u in quality._units(word) for g in quality._unit_grams(u)] == quality._grams(word)


def test_words_take_few_steps():
    from tessaphon.llm import wfst

    spaces = sentencepiece_fst.normaliser(True, False)
    out, weight = spaces.compose("ab " * 1000)
    assert "".join(out) == "▁" + "ab▁" * 1000 and weight == 0.0 and len(out) < 10  # 2,002 parts before
    assert "".join(sentencepiece_fst.normaliser(True, True).compose("  a   b ")[0]) == "▁a▁b"
    # Only lengths that a piece can have are tried: 3 and 1 after "abc", though a piece of 9 begins with "ab".
    pieces = {p: k for k, p in enumerate(["a", "b", "c", "ab", "abc", "abxxxxxxx"])}
    merges = wfst.Merges(lambda a, b: {"ab": 0.0, "abc": 1.0}.get(a + b))
    machine = wfst.MergeTransducer(pieces, merges)
    assert machine.lengths["abc"] == (3, 2, 1) and machine.lengths["abx"] == (9, 2, 1)
    assert machine.shortest("abcabab?c") == ["abc", "ab", "ab", "?", "c"]


def test_remembered_values_are_bounded_over_languages(monkeypatch):
    import xxhash

    monkeypatch.setattr(quality, "REMEMBERED", 200)
    r = np.random.default_rng(4)
    words = ["".join(r.choice(list("abcdeß"), r.integers(1, 9))) for _ in range(400)]
    entries = {}
    for lang in map(str, range(12)):
        entries[lang, "b", ""] = -3.0
        for w in words[:: 2 + int(lang) % 3]:
            for g in quality._grams(w):
                for k in range(1, quality.ORDER + 1):
                    entries[lang, "p", g[-k:]] = -float(r.random()) - k
                    entries[lang, "b", g[-k:]] = -float(r.random())

    def key(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part.encode(), seed)
        return seed

    def gram(lang, g):
        weight = 0.0
        for k in range(quality.ORDER, 0, -1):
            if (lang, "p", g[-k:]) in entries:
                return weight + entries[lang, "p", g[-k:]]
            weight += entries.get((lang, "b", g[-k:-1]), 0.0)
        return weight

    pairs = sorted((key(*parts), value) for parts, value in entries.items())
    shard = quality.Shard(np.array([k for k, _ in pairs], np.uint64), np.array([v for _, v in pairs]))
    assert shard.units("none", ["\x02a\x03"]) is None
    for turn in range(3):
        for lang in map(str, range(12)):
            for at in range(0, 400, 40):
                units = [u for w in words[at : at + 40] for u in quality._units(w)]
                known = shard.units(lang, units)
                assert all(known[u] == -sum(gram(lang, g) for g in quality._unit_grams(u)) for u in units)
                held = sum(len(x) for found in (shard.young, shard.old) for both in found.values() for x in both)
                assert held <= 2 * (200 + 40 * 12)  # 12 times as many before: each language had its own bound


def test_workers_that_wait_hold_nothing(spark):
    """A worker is used again by the next operator, with what the last one left in it."""
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(200)) for _ in range(40)]
    docs = spark.createDataFrame([(i, x, "en") for i, x in enumerate(texts)], "doc_id long, text string, lang string").repartition(4).cache()
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        packing.pieces(docs, file.read(), 4096, 1).count()
    keyed = docs.select("lang", F.xxhash64("text").alias("k1"), F.xxhash64("doc_id").alias("k2"), "text")
    quality.Model(quality.train(docs.select("lang", "text"))).of_texts(keyed).count()

    def remembered(batches):
        import sys

        for _ in batches:
            pass
        bpe, model = sys.modules.get("tessaphon.llm.word_bpe"), sys.modules.get("tessaphon.llm.quality")
        n = sum(len(m) + len(m.old) for tok in getattr(bpe, "_made", {}).values() for m in (tok.words, tok.chunks)) + len(getattr(model, "_shards", {}))
        yield pa.RecordBatch.from_pydict({"n": [n], "used": [bpe is not None]})

    found = docs.select("doc_id").mapInArrow(remembered, "n long, used boolean").collect()
    assert any(x["used"] for x in found) and all(x["n"] == 0 for x in found)


def test_tables_are_cut_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = cut(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"), "batch-sizes").collect()
    assert sum(x["n"] for x in found) == 5000 and max(x["n"] for x in found) <= BATCH_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
