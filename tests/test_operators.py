import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tessaphon.functions import arrays, names
from tessaphon.operators import chunks, mixing, phonemes, positions
from tessaphon.sources import textgrid


def sounds(spark, n, size=4, start=0):
    return spark.createDataFrame([(i, [float(i + start)] * size) for i in range(n)], "key long, y array<float>")


def test_chunks(spark):
    r = spark.createDataFrame([("a", 2, [1.0] * 5), ("b", 2, [1.0]), ("c", 2, [])], "file_name string, sr int, y array<float>")
    assert sorted((x.file_name, x.chunk_idx, len(x.y)) for x in chunks.chunk(r, 1.0).collect()) == [("a", 0, 2), ("a", 1, 2)]
    assert sorted((x.file_name, len(x.y)) for x in chunks.chunk(r, 1.0, keep_tail=True).collect()) == [("a", 1), ("a", 2), ("a", 2), ("b", 1)]
    totals = {x.file_name: (x.total_duration_sec, x.num_chunks) for x in chunks.file_totals(r, 1.0).collect()}
    assert totals == {"a": (2.5, 2), "b": (0.5, 0), "c": (0.0, 0)}
    assert tuple(chunks.summary(chunks.file_totals(r, 1.0)).first()) == (2, 3.0)
    with pytest.raises(ZeroDivisionError):
        chunks.chunk(r, 0)


def test_augment(spark):
    out = chunks.augment(sounds(spark, 20), "key", 3).orderBy("ord").collect()
    assert [x.ord for x in out] == list(range(40))
    assert all((x.steps is None) == (x.variant == 0) for x in out)
    assert all(-6 <= x.steps <= 6 for x in out if x.variant)
    assert chunks.augment(sounds(spark, 20), "key", enabled=False).count() == 20


def test_mix_average_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), ([2.0], [1.0, 5.0])], "a array<float>, b array<float>")
    assert [x.m for x in df.select(arrays.average(F.col("a"), F.col("b")).alias("m")).collect()] == [[2.0, 3.0], [1.5, 3.5]]
    wrong = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0, 5.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="lengths differ"):
        wrong.select(arrays.average(F.col("a"), F.col("b"))).collect()


@pytest.mark.parametrize(("percent", "start", "n"), [(0.5, 0, 5), (0.0, 0, 0), (-0.3, 0, 0), (1.0, 0, 10), (0.35, 1, 3)])
def test_aligned(spark, percent, start, n):
    out = mixing.mix_aligned_subset(sounds(spark, 10), sounds(spark, 12), percent, "key", 1, start).collect()
    assert len(out) == n and all(x.i >= start and x.y[0] == x.i for x in out)


def test_aligned_errors(spark):
    for percent, start in ((1.5, 0), (1.0, 1)):
        with pytest.raises(ValueError):
            mixing.mix_aligned_subset(sounds(spark, 10), sounds(spark, 10), percent, "key", 1, start)


def test_masks(spark):
    empty = sounds(spark, 1).limit(0)
    fg, bg = sounds(spark, 30), sounds(spark, 7, start=100)
    out = mixing.masking_dataset(fg, bg, "m", "key", 5)
    first = sorted(map(tuple, out.select("fg", "bg").collect()))
    assert len(first) == 30 and {b for _, b in first} <= set(range(7))
    assert first == sorted(map(tuple, mixing.masking_dataset(fg.repartition(3), bg, "m", "key", 5).select("fg", "bg").collect()))
    with pytest.raises(ValueError, match="empty"):
        mixing.mix_random_background(empty, empty, "key")
    assert mixing.masking_dataset(empty, empty, "m", "key").count() == 0


def test_positions_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(positions, "TOGETHER", 10)
    df = spark.range(95).select((F.col("id") * 3).alias("o"), (F.col("id") % 2).alias("g"))
    out = positions.with_position(df, ["g"], "o").orderBy("g", "o").collect()
    assert [x.i for x in out] == [*range(48), *range(47)]
    assert sorted(x.rk for x in positions.sample_rank(df, 1, "p", "o").collect()) == list(range(1, 96))


def test_interpolation(spark):
    df = spark.createDataFrame([(3, [0.0, 1.0, 4.0]), (1, [5.0])], "len int, data array<double>")
    assert [x.data for x in phonemes.to_length(df, 5).orderBy("len").collect()] == [[5.0] * 5, [0.0, 0.5, 1.0, 2.5, 4.0]]
    assert [x.data for x in phonemes.to_length(df, 1).orderBy("len").collect()] == [[5.0], [0.0]]
    assert {len(x.data) for x in phonemes.to_extreme_length(df, False).collect()} == {3}
    with pytest.raises(ValueError):
        phonemes.to_extreme_length(df.limit(0), True)
    with pytest.raises(Exception, match="key differs"):
        phonemes.to_length(df.withColumn("len", F.lit(9)), 4).collect()


def test_names(spark):
    df = spark.createDataFrame([("<p:>",), ("?",), ("h\\",), ("",), ("a:",)], "p string")
    assert [x[0] for x in df.select(names.partition_name(F.col("p"))).collect()] == ["pause", "unknown", "hhh", "_empty", "a:"]
    files = spark.createDataFrame([("noise.npz",), ("pizza.npz",)], "f string")
    assert [tuple(x) for x in files.select(names.label_of_archive(F.col("f")), names.label_of_archive(F.col("f"), True)).collect()] == [("noise", "oise"), ("pizza", "izza")]


def loop(lines):
    """The tier rules as a plain loop."""
    tier, found = -1, {"xmin": [], "xmax": [], "text": []}
    for line in lines:
        p = [x.strip('"') for x in line.split()]
        if len(p) != 3:
            continue
        if p[2] == "ORT-MAU":
            tier += 1
        elif p[2] == "MAU":
            tier = 1
        if tier == 1 and p[0] in found:
            found[p[0]].append(p[2])
    return list(zip(found["text"], map(float, found["xmin"][1:]), map(float, found["xmax"][1:]), strict=False))


LINE = st.sampled_from(['name = "ORT-MAU"', 'name = "MAU"', "xmin = 0.5", "xmax = 1.25", 'text = "a"', 'text = ""', 'text = "a b"', 'text = "MAU"', "  xmin = 2 ", "item [1]:"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(LINE, max_size=25), min_size=1, max_size=12))
def test_textgrid_rules(spark, documents):
    texts = spark.createDataFrame(list(enumerate("\n".join(d) for d in documents)), "sample_id int, text string")
    got = {}
    for x in textgrid.phone_intervals(textgrid.text_lines(texts)).orderBy("sample_id", "ord").collect():
        got.setdefault(x.sample_id, []).append((x.phone, x.t0, x.t1))
    assert got == {k: v for k, d in enumerate(documents) if (v := loop(d))}


def test_textgrid_strict(spark):
    text = '\n'.join(['name = "MAU"', "xmin = 0", "xmax = 9", "xmin = 0", "xmax = 1", 'text = "a b"'])
    lines = textgrid.text_lines(spark.createDataFrame([(1, text)], "sample_id int, text string"))
    with pytest.raises(Exception, match="differ in number"):
        textgrid.phone_intervals(lines, "strict").collect()
    assert textgrid.phone_intervals(lines).count() == 0


def test_chunks_of_no_whole_number_of_samples(spark):
    r = spark.createDataFrame([("a", 3, [float(k) for k in range(10)])], "file_name string, sr int, y array<float>")
    # 1.5 samples a chunk: six chunks, as file_totals says, that start at 0, 1.5, 3 and so on, to the nearest even.
    assert [x.y[0] for x in chunks.chunk(r, 0.5).orderBy("chunk_idx").collect()] == [0.0, 2.0, 3.0, 4.0, 6.0, 8.0]
    assert chunks.file_totals(r, 0.5).first().num_chunks == 6


def test_places(spark):
    df = spark.createDataFrame([(f"{k % 7}-{k}",) for k in range(50)], "path string").repartition(5)
    out = positions.with_place(df, "path", "n").orderBy("n").collect()
    assert [x.n for x in out] == list(range(50)) and [x.path for x in out] == sorted(x.path for x in out)


def test_file_names(spark):
    f = spark.createDataFrame([("x [abc].opus",), ("abc.opus.part",), ("abc.wav",), ("a.b.WAV",)], "f string")
    got = [tuple(x) for x in f.select(names.download_of(F.col("f"), "abc"), names.is_wav(F.col("f")), names.stem(F.col("f"))).collect()]
    assert got == [(True, False, "x [abc]"), (True, False, "abc.opus"), (False, True, "abc"), (False, False, "a.b")]


def test_tone(spark):
    y = spark.range(1).select(arrays.tone(220.0, 0.5, 8000).alias("y")).first().y
    assert len(y) == 4000 and abs(y[9] - 0.5 * math.sin(2 * math.pi * 220 * 9 / 8000)) < 1e-6
