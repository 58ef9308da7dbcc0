import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tessaphon.config import Decoding, Spectrum
from tessaphon.kernels.files import encode_wav, write_npz
from tessaphon.kernels.udfs import feature
from tessaphon.plans import jobs
from tessaphon.sources import archives, audio
from tessaphon.streaming import stream_chunks

SR = 4000
CONFIG, SPEC = Decoding(rate=SR), Spectrum(window=256, step=64, bands=16)


def wav(path, seconds, f=220.0, sr=SR):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(encode_wav(0.5 * np.sin(2 * np.pi * f * np.arange(int(seconds * sr)) / sr), sr))


@pytest.fixture
def folders(tmp_path):
    wav(tmp_path / "voice/tail.wav", 2.5)
    wav(tmp_path / "voice/UP.WAV", 1.0)
    wav(tmp_path / "voice/short.wav", 0.4)
    (tmp_path / "voice/note.txt").write_text("x")
    wav(tmp_path / "music/a.b.wav", 3.0, 440)
    wav(tmp_path / "music/eight.wav", 1.0, 440, 8000)
    return tmp_path


def test_listing_and_decoding(spark, folders):
    found = audio.ordered(audio.audio_files(spark, f"file://{folders}/voice"))
    assert [x.file_name for x in found.orderBy("file_ord").collect()] == ["UP.WAV", "short.wav", "tail.wav"]
    assert audio.audio_files(spark, f"file://{folders}/voice", filter_ext=False).count() == 4
    got = {x.file_name: (x.sr, x.sr_native, len(x.y)) for x in audio.recordings(audio.audio_files(spark, f"file://{folders}/music"), CONFIG).collect()}
    assert got == {"a.b.wav": (SR, SR, 3 * SR), "eight.wav": (SR, 8000, SR)}


def test_class_dataset(spark, folders):
    paths = {n: f"file://{folders}/{n}" for n in ("voice", "music")}
    out = jobs.class_dataset(spark, paths, ["voice"], ["music"], 1.0, CONFIG, SPEC, 3)
    rows = out.collect()
    labels = [x.label for x in rows]
    assert labels.count("voice") == 6 and labels.count("voice_music") == 6
    assert all(x.shape == [16, 1 + SR // 64] and len(x.re) == np.prod(x.shape) for x in rows)


def test_phoneme_job(spark, tmp_path):
    text = ['name = "ORT-MAU"', 'text = "w"', 'name = "MAU"', "xmin = 0", "xmax = 1"]
    for k, p in enumerate(["a:", "?", ""]):
        text += [f"xmin = {k * 0.25}", f"xmax = {k * 0.25 + 0.25}", f'text = "{p}"']
    for sid, coding in (("1", "utf-8"), ("2", "utf-16")):
        wav(tmp_path / f"in/{sid}/x.wav", 1.0)
        (tmp_path / f"in/{sid}/x.TextGrid").write_text("\n".join(text), encoding=coding)
    root = f"file://{tmp_path}/in"
    features, counts = jobs.phoneme_features(spark, root, ["1", "2"], "stft", CONFIG, SPEC)
    assert {x.phone: x.n for x in counts.collect()} == {"a:": 2, "?": 2, "": 2}
    assert features.filter("safe_name = 'unknown'").count() == 2
    jobs.write_phoneme_features(spark, root, f"file://{tmp_path}/out", kind="mel", how=CONFIG, spectrum=SPEC)
    back = archives.read_features(spark, f"file://{tmp_path}/out")
    assert {x.safe_name for x in back.select("safe_name").collect()} == {"a:", "unknown", "_empty"}
    with pytest.raises(Exception, match="missing wav or textgrid in 3"):
        jobs.phoneme_features(spark, root, ["1", "3"], "stft", CONFIG, SPEC)[1].collect()


def test_kinds():
    with pytest.raises(ValueError, match="unknown feature kind"):
        feature("nope", SPEC)


def test_archives(spark, tmp_path):
    (tmp_path / "noise.npz").write_bytes(write_npz([np.zeros((1, 2, 3)), np.ones((2, 2)) * 1j]))
    got = archives.read_npz(spark, f"file://{tmp_path}").orderBy("arr_idx").collect()
    assert [(x.label, x.shape, x.dtype) for x in got] == [("noise", [2, 3], "float32"), ("noise", [2, 2], "complex64")]
    df = archives.read_npz(spark, f"file://{tmp_path}")
    out = archives.write_npz(df, f"file://{tmp_path}/again").collect()
    assert [x.safe_name for x in out] == ["noise"]
    assert archives.read_npz(spark, f"file://{tmp_path}/again").count() == 2
    sounds = spark.createDataFrame([("a.b_0", [0.0, 0.5])], "n string, y array<float>")
    assert archives.write_wavs(sounds, f"file://{tmp_path}/w", F.col("n"), SR).first().path.endswith("a.b_0.wav")


def test_stream(spark, folders, tmp_path):
    query = stream_chunks(spark, f"file://{folders}/voice", 1.0, CONFIG).writeStream.format("memory").queryName("chunks").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((x.file_name, x.chunk_idx) for x in spark.table("chunks").collect()) == [("UP.WAV", 0), ("tail.wav", 0), ("tail.wav", 1)]


def test_every_file_is_decoded_once(spark, folders, monkeypatch, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def counting(how):
        @F.pandas_udf("sr int, sr_native int, n_native long, shape array<int>, y array<float>")
        def decode(contents: pd.Series, suffixes: pd.Series) -> pd.DataFrame:
            from tessaphon.kernels import files

            out = []
            for content, name in zip(contents, suffixes, strict=True):
                (log / uuid.uuid4().hex).touch()
                sr, native, n, y = files.load(content, name, how.rate, how.mixed)
                out.append((sr, native, n, [y.shape[1]], y.ravel()))
            return pd.DataFrame(out, columns=["sr", "sr_native", "n_native", "shape", "y"])

        return decode

    monkeypatch.setattr(audio, "decoder", counting)
    made = jobs.class_chunks(spark, f"file://{folders}/voice", 1.0, CONFIG)
    jobs.mixing.mix_aligned_subset(made, made, 0.5, "ord").count()
    jobs.mixing.mix_random_background(made, made, "ord").count()
    assert len(list(log.iterdir())) == 3


def test_class_job_writes_archives_and_sounds(spark, folders, tmp_path):
    paths = {n: f"file://{folders}/{n}" for n in ("voice", "music")}
    told = jobs.write_class_dataset(spark, paths, ["voice"], ["music"], f"file://{tmp_path}/out", f"file://{tmp_path}/npz", seconds=1.0, how=CONFIG, spectrum=SPEC, wavs=f"file://{tmp_path}/wavs")
    assert {x.label: x.n for x in told.collect()} == {"voice": 6, "voice_music": 6}
    assert sorted(x.name for x in (tmp_path / "npz").glob("*.npz")) == ["voice.npz", "voice_music.npz"]
    assert archives.read_npz(spark, f"file://{tmp_path}/npz").count() == 12
    # Copies are numbered with the chunks; dots in names stay.
    assert sorted(x.name for x in (tmp_path / "wavs/voice").glob("*.wav")) == ["UP_0.wav", "UP_1.wav", *(f"tail_{k}.wav" for k in range(4))]
    assert len(list((tmp_path / "wavs/music").glob("a.b_*.wav"))) == 6
    assert sorted(x.name for x in (tmp_path / "wavs/voice_music").glob("*.wav")) == sorted(f"{n}_{k}.wav" for n in ("fg", "mix") for k in range(6))
    assert not list((folders / "voice").glob("*_0.wav"))


def test_legacy_numbers_and_mixed_mels(spark, folders, tmp_path):
    chunks = jobs.class_chunks(spark, f"file://{folders}/voice", 1.0, CONFIG)
    assert jobs.dump_chunks(chunks, f"file://{tmp_path}/old", SR, legacy=True) == 3
    assert sorted(x.name for x in (tmp_path / "old").glob("*.wav")) == ["UP_2.wav", "tail_2.wav", "tail_4.wav"]
    mels = jobs.features_of(chunks, F.lit("voice"), "mel", SPEC).select("ord", F.col("re").alias("y"), "shape")
    out = jobs.mixed_mels(spark, mels, mels, "both", 0.5, f"file://{tmp_path}/mixed", hop_length=64, spectrum=SPEC)
    assert {x.label for x in out.collect()} == {"both"} and out.count() == 3


def test_too_many_chunks(spark, folders, monkeypatch):
    monkeypatch.setattr(jobs, "PER_FILE", 1)
    with pytest.raises(Exception, match="too many chunks in tail.wav"):
        jobs.class_chunks(spark, f"file://{folders}/voice", 1.0, CONFIG)


def test_shapes_must_agree(spark):
    from tessaphon.operators import analysis

    with pytest.raises(ValueError, match="several shapes"):
        analysis.clusters(spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "y array<double>"), "y", 2)
