import math

import numpy as np
import pytest
from tessaphon.kernels import files, spectral


def tone(f=220.0, seconds=1.0, sr=22050):
    return 0.5 * np.sin(2 * np.pi * f * np.arange(int(seconds * sr)) / sr)


def test_stft_peak_and_shape():
    s = spectral.stft(tone(), 2048, 256)
    assert s.shape == (1025, 87)
    assert np.abs(s[:, 40]).argmax() == 20


def test_istft_inverts():
    y = np.random.default_rng(0).standard_normal(5000)
    assert np.allclose(spectral.istft(spectral.stft(y, 512, 128), 128, 5000), y, atol=1e-6)


def test_mel_and_dct():
    assert spectral.mel(tone(), 22050, 2048, 256, None, 256).shape == (256, 87)
    m = spectral.dct_matrix(20, 20)
    assert np.allclose(m @ m.T, np.eye(20))
    assert spectral.mfcc(tone()).shape[0] == 20
    assert np.isclose(spectral.mel_to_hz(spectral.hz_to_mel(3000.0)), 3000)


def test_chroma_of_a():
    c = spectral.chroma(tone(440), n_chroma=12)
    assert c[:, 10].argmax() == 9
    assert np.allclose(c.max(axis=0), 1)


def test_stretch_lengths():
    y = tone(seconds=0.5)
    assert len(spectral.time_stretch(y, 1.25)) == round(len(y) / 1.25)
    assert len(spectral.time_stretch(y, 0.5)) == 2 * len(y)
    assert len(spectral.constant_timeframe(y)) == 29400
    assert len(spectral.constant_timeframe(tone(seconds=2.0))) == 29400
    with pytest.raises(ValueError):
        spectral.time_stretch(y, 0)


def test_pitch_shift_moves_the_peak():
    y = spectral.pitch_shift(tone(440), 22050, 12)
    assert len(y) == 22050
    peak = np.abs(np.fft.rfft(y[4000:18000])).argmax() * 22050 / 14000
    assert abs(peak - 880) < 15


def test_resample():
    y = spectral.resample(tone(100, 1.0, 8000), 22050 / 8000, 22050)
    assert np.abs(np.fft.rfft(y)).argmax() == 100


def test_mel_to_audio_keeps_the_pitch():
    m = spectral.mel(tone(440), hop=512)
    y = spectral.mel_to_audio(m, hop=512)
    assert abs(np.abs(np.fft.rfft(y)).argmax() * 22050 / len(y) - 440) < 30
    assert np.array_equal(y, spectral.mel_to_audio(m, hop=512))


def test_wav_and_npz_round_trip():
    y = tone()
    rate, back = files.decode_wav(files.encode_wav(y, 22050))
    assert rate == 22050 and back.shape == (1, 22050) and np.abs(back[0] - y).max() < 1e-3
    arrays = [np.arange(6.0).reshape(2, 3), np.arange(4.0)]
    assert all(np.array_equal(a, b) for a, b in zip(arrays, files.read_npz(files.write_npz(arrays)), strict=True))
    old = files.read_npz(files.write_npz([np.zeros((1, 3, 2))]), explode_leading=True)
    assert old[0].shape == (3, 2)


def test_no_decoder():
    with pytest.raises(ValueError, match="no decoder for .mp3"):
        files.load(b"", ".mp3", 22050, True)


def test_aiff():
    import struct

    y = tone(seconds=0.1, sr=8000)
    whole = np.round(y * 32767).astype(int)
    rate = struct.pack(">HQ", 16383 + 12, 8000 << (63 - 12))
    for bits, coding, data in ((16, None, whole.astype(">i2").tobytes()), (16, b"sowt", whole.astype("<i2").tobytes()), (24, None, b"".join(int(v * 256).to_bytes(3, "big", signed=True) for v in whole))):
        comm = struct.pack(">hIh", 1, len(y), bits) + rate + (coding + b"\0\0" if coding else b"")
        chunks = [(b"COMM", comm), (b"JUNK", b"abc\0"), (b"SSND", bytes(8) + data)]
        body = b"".join(k + struct.pack(">I", len(d)) + d for k, d in chunks)
        content = b"FORM" + struct.pack(">I", len(body) + 4) + (b"AIFC" if coding else b"AIFF") + body
        got, back = files.DECODERS[".aiff"](content)
        assert got == 8000 and back.shape == (1, 800) and np.abs(back[0] - y).max() < 1e-3
    with pytest.raises(ValueError, match="not an AIFF"):
        files.decode_aiff(b"RIFF" + bytes(20))


def test_tuning():
    for off in (-0.3, 0.0, 0.2):
        power = np.abs(spectral.stft(tone(440 * 2 ** (off / 12)) + tone(660 * 2 ** (off / 12) * 2 ** (7 / 12) / 1.5))) ** 2
        assert abs(spectral.tuning_of(power, 22050) - off) < 0.06
    assert spectral.tuning_of(np.zeros((1025, 4)), 22050) == 0.0
    sharp = tone(440 * 2 ** (0.4 / 12))
    assert spectral.chroma(sharp, n_chroma=12, tuning=None)[9].mean() > spectral.chroma(sharp, n_chroma=12)[9].mean() - 1e-9


def test_banks_against_their_definitions():
    # Mel bands, the DCT and a band's frequencies by the published formulas, point by point.
    def hz(m):
        return m * 200 / 3 if m < 15 else 1000 * math.exp((m - 15) * math.log(6.4) / 27)

    sr, n_fft, n = 64, 32, 8
    top = (sr / 2) * 3 / 200
    edges = [hz(top * k / (n + 1)) for k in range(n + 2)]
    bank = spectral.mel_bank(sr, n_fft, n)
    for j in range(n):
        for b in range(n_fft // 2 + 1):
            f = b * sr / n_fft
            left, middle, right = edges[j : j + 3]
            height = max(0.0, min((f - left) / (middle - left), (right - f) / (right - middle)))
            assert bank[j, b] == pytest.approx(height * 2 / (right - left), abs=1e-12)
    dct = spectral.dct_matrix(5, 8)
    for k in range(5):
        for j in range(8):
            assert dct[k, j] == pytest.approx(math.cos(math.pi * k * (j + 0.5) / 8) * math.sqrt((1 if k == 0 else 2) / 8))


def test_stretch_makes_only_frames_that_are_heard(monkeypatch):
    made, istft = [], spectral.istft
    monkeypatch.setattr(spectral, "istft", lambda s, hop, length: made.append(s.shape[1]) or istft(s, hop, length))
    y = np.random.default_rng(3).standard_normal(64)
    out = spectral.constant_timeframe(y)
    assert len(out) == 29400 and made == [60]  # 460 of them before, of which 400 lay behind the end
    # One frame, whose spectrum turns back by its own angle at each step.
    s, rate = np.fft.rfft(np.pad(y, (1024, 960)) * spectral.hann(2048, 2048)), 0.75 * 64 / 22050
    frames = np.stack([(1 - j * rate) * np.abs(s) * np.exp(1j * np.angle(s) * (1 - j)) for j in range(460)], axis=1)
    assert np.allclose(out, istft(frames, 512, 29400), atol=1e-9)


def test_batches_of_long_results_are_sent_in_parts(spark, monkeypatch):
    import pandas as pd
    from tessaphon.kernels import udfs

    monkeypatch.setattr(udfs, "SENT", 100)
    rows = pd.Series([np.ones(3), None, np.ones(0), *[np.full(2, float(k)) for k in range(20)]])
    parts = list(udfs.flat(lambda y: np.repeat(y, 30)).func(iter([rows, rows[:0]])))
    assert max(sum(0 if y is None else len(y) for y in p) for p in parts) < 200 and len(parts) > 5
    whole = [y for p in parts for y in p]
    assert len(whole) == len(rows) and whole[1] is None and len(whole[2]) == 0 and whole[-1].tolist() == [19.0] * 60
