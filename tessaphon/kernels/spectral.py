"""Spectral kernels on NumPy arrays, without Spark."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


@lru_cache(maxsize=32)
def hann(win_length: int, n_fft: int) -> np.ndarray:
    """Periodic Hann window, centred in n_fft samples."""
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(win_length) / win_length)
    left = (n_fft - win_length) // 2
    return np.pad(w, (left, n_fft - win_length - left))


def frames(y: np.ndarray, n_fft: int, hop: int, center: bool = True) -> np.ndarray:
    """Frames as rows; with center, half a window of zeros on both sides."""
    if center:
        y = np.pad(y, n_fft // 2)
    if len(y) < n_fft:
        y = np.pad(y, (0, n_fft - len(y)))
    return np.lib.stride_tricks.sliding_window_view(y, n_fft)[::hop]


def stft(y, n_fft: int = 2048, hop: int = 512, win_length: int | None = None, center: bool = True) -> np.ndarray:
    """Complex spectrum, bins by frames."""
    return np.fft.rfft(frames(np.asarray(y, float), n_fft, hop, center) * hann(win_length or n_fft, n_fft), axis=1).T


@lru_cache(maxsize=32)
def squared_windows(count: int, n_fft: int, hop: int) -> np.ndarray:
    """What the squared windows of so many frames add up to; 1 where next to nothing."""
    w, norm = hann(n_fft, n_fft), np.zeros(n_fft + hop * (count - 1))
    for k in range(count):
        norm[k * hop : k * hop + n_fft] += w * w
    return np.where(norm > 1e-8, norm, 1)


def istft(spectrum: np.ndarray, hop: int, length: int | None = None) -> np.ndarray:
    """Overlap-add with the squared window divided out."""
    n_fft = 2 * (spectrum.shape[0] - 1)
    parts = np.fft.irfft(spectrum.T, n_fft, axis=1) * hann(n_fft, n_fft)
    out = np.zeros(n_fft + hop * (len(parts) - 1))
    for k, p in enumerate(parts):
        out[k * hop : k * hop + n_fft] += p
    out = (out / squared_windows(len(parts), n_fft, hop))[n_fft // 2 :]
    length = max(0, len(out) - n_fft // 2) if length is None else length
    return np.pad(out, (0, max(0, length - len(out))))[:length]


def hz_to_mel(f):
    """Linear below 1 kHz (3 mels in 200 Hz), logarithmic above (27 mels for a factor of 6.4)."""
    f = np.asarray(f, float)
    return np.where(f < 1000, f * 3 / 200, 15 + 27 * np.log(np.maximum(f, 1000) / 1000) / np.log(6.4))


def mel_to_hz(m):
    m = np.asarray(m, float)
    return np.where(m < 15, m * 200 / 3, 1000 * 6.4 ** ((m - 15) / 27))


@lru_cache(maxsize=32)
def mel_bank(sr: int, n_fft: int, n_mels: int) -> np.ndarray:
    """Triangles of equal area, mels by bins."""
    edges = mel_to_hz(np.linspace(0, hz_to_mel(sr / 2), n_mels + 2))
    f = np.linspace(0, sr / 2, n_fft // 2 + 1)
    rise = (f - edges[:-2, None]) / np.diff(edges)[:-1, None]
    fall = (edges[2:, None] - f) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(rise, fall)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def mel(y, sr: int = 22050, n_fft: int = 2048, hop: int = 512, win_length: int | None = None, n_mels: int = 128, center: bool = True) -> np.ndarray:
    """Mel power, mels by frames."""
    return mel_bank(sr, n_fft, n_mels) @ np.abs(stft(y, n_fft, hop, win_length, center)) ** 2


def decibels(power: np.ndarray, floor_db: float = 80.0) -> np.ndarray:
    db = 10 * np.log10(np.maximum(power, 1e-10))
    return np.maximum(db, db.max() - floor_db) if db.size else db


@lru_cache(maxsize=8)
def dct_matrix(n_out: int, n: int) -> np.ndarray:
    """Orthonormal DCT-II."""
    k = np.arange(n_out)[:, None]
    m = np.cos(np.pi * k * (2 * np.arange(n) + 1) / (2 * n)) * np.sqrt(2 / n)
    m[0] /= np.sqrt(2)
    return m


def mfcc(y, sr: int = 22050, n_mfcc: int = 20, n_mels: int = 128, n_fft: int = 2048, hop: int = 512, center: bool = True) -> np.ndarray:
    return dct_matrix(n_mfcc, n_mels) @ decibels(mel(y, sr, n_fft, hop, None, n_mels, center))


@lru_cache(maxsize=8)
def chroma_bank(sr: int, n_fft: int, n_chroma: int, tuning: float = 0.0) -> np.ndarray:
    """Gaussian pitch classes (first: C), weighted by octave, columns of unit length; chroma by bins."""
    f = np.arange(1, n_fft) * sr / n_fft
    tones = n_chroma * np.log2(f / (440 * 2 ** (tuning / n_chroma) / 16))
    tones = np.concatenate([[tones[0] - 1.5 * n_chroma], tones])
    width = np.concatenate([np.maximum(np.diff(tones), 1.0), [1.0]])
    d = tones - np.arange(n_chroma)[:, None]
    d = np.mod(d + n_chroma // 2 + 10 * n_chroma, n_chroma) - n_chroma // 2
    w = np.exp(-0.5 * (2 * d / width) ** 2)
    w /= np.maximum(np.sqrt((w**2).sum(axis=0)), 1e-12)
    w *= np.exp(-0.5 * ((tones / n_chroma - 5) / 2) ** 2)
    return np.roll(w, -3 * (n_chroma // 12), axis=0)[:, : n_fft // 2 + 1]


def peaks(magnitude: np.ndarray, sr: int, low: float = 150.0, high: float = 4000.0, least: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and heights of the spectral peaks of all frames, between the bins by a parabola through three of them."""
    n_fft = 2 * (magnitude.shape[0] - 1)
    left, here, right = magnitude[:-2], magnitude[1:-1], magnitude[2:]
    hz = np.arange(1, magnitude.shape[0] - 1)[:, None] * sr / n_fft
    tall = here > least * magnitude.max(axis=0, keepdims=True, initial=0.0)
    k, frame = np.nonzero((here > left) & (here >= right) & tall & (hz >= low) & (hz < high))
    a, b, c = left[k, frame], here[k, frame], right[k, frame]
    slope, bend = (c - a) / 2, 2 * b - a - c
    shift = np.where(np.abs(bend) > 1e-12, slope / np.where(bend == 0, 1, bend), 0.0)
    return (k + 1 + shift) * sr / n_fft, b + slope * shift / 2


def tuning_of(power: np.ndarray, sr: int, per_octave: int = 12, resolution: float = 0.01) -> float:
    """How far a sound's tones lie from those around 440 Hz, in parts of a tone (-0.5 to 0.5): the most frequent of its louder peaks."""
    hz, height = peaks(power, sr)
    hz = hz[height >= np.median(height)] if len(height) else hz
    if not len(hz):
        return 0.0
    off = np.mod(per_octave * np.log2(hz / 440), 1.0)
    off[off >= 0.5] -= 1.0
    counts, edges = np.histogram(off, np.linspace(-0.5, 0.5, int(np.ceil(1 / resolution)) + 1))
    return float(edges[counts.argmax()])


def chroma(y, sr: int = 22050, n_fft: int = 2048, hop: int = 512, win_length: int | None = None, n_chroma: int = 48, center: bool = True, tuning: float | None = 0.0) -> np.ndarray:
    """Pitch classes by frames, the largest of a frame 1; without a tuning, the sound's own."""
    power = np.abs(stft(y, n_fft, hop, win_length, center)) ** 2
    raw = chroma_bank(sr, n_fft, n_chroma, tuning_of(power, sr, n_chroma) if tuning is None else tuning) @ power
    top = raw.max(axis=0, keepdims=True) if raw.size else raw
    return raw / np.where(top > 1e-12, top, 1)


def resample(y, up: float, length: int, taps: int = 32) -> np.ndarray:
    """Windowed-sinc resampling by the factor ``up`` to ``length`` samples."""
    y = np.asarray(y, float)
    if not len(y) or not length:
        return np.zeros(length)
    cut, half = min(1.0, up), int(np.ceil(taps / min(1.0, up)))
    out = np.empty(length)
    for a in range(0, length, 8192):
        at = np.arange(a, min(length, a + 8192)) / up
        k = np.floor(at).astype(int)[:, None] + np.arange(-half + 1, half + 1)
        d = at[:, None] - k
        w = cut * np.sinc(cut * d) * np.where(np.abs(d) < half, 0.5 + 0.5 * np.cos(np.pi * d / half), 0)
        inside = (k >= 0) & (k < len(y))
        out[a : a + len(at)] = (w * np.where(inside, y[np.clip(k, 0, len(y) - 1)], 0)).sum(axis=1)
    return out


def time_stretch(y, rate: float, n_fft: int = 2048, hop: int = 512) -> np.ndarray:
    """Phase vocoder: a rate above 1 shortens; round(n / rate) samples."""
    if rate <= 0:
        raise ValueError("rate must be positive")
    y = np.asarray(y, float)
    length = int(round(len(y) / rate))
    if not len(y):
        return np.zeros(length)
    s = stft(y, n_fft, hop)
    s = np.pad(s, ((0, 0), (0, 2)))
    # Frames that begin after the last sample don't reach it.
    at = np.arange(0, s.shape[1] - 2, rate)[: -(-(length + n_fft // 2) // hop)]
    k, part = at.astype(int), at % 1
    # Frames by bins.  A step turns by the difference of two spectra's angles, whatever whole turns are added to it.
    sizes, turned = np.abs(s).T, np.exp(1j * np.angle(s)).T
    steps = turned[1:] * turned[:-1].conj()
    out = np.empty((len(at), s.shape[0]), complex)
    out[0] = turned[0]
    for i in range(1, len(at)):
        np.multiply(out[i - 1], steps[k[i - 1]], out=out[i])
    out *= (1 - part)[:, None] * sizes[k] + part[:, None] * sizes[k + 1]
    return istft(out.T, hop, length)


def pitch_shift(y, sr: int, steps: int, n_fft: int = 2048, hop: int = 512) -> np.ndarray:
    """Semitones up, at the same length."""
    y = np.asarray(y, float)
    rate = 2.0 ** (-steps / 12)
    return resample(time_stretch(y, rate, n_fft, hop), rate, len(y))


def constant_timeframe(y, sr: int = 22050) -> np.ndarray:
    """Stretched at 0.75 of its own duration: 4/3 s for every input."""
    return time_stretch(y, 0.75 * len(y) / sr) if len(y) else np.zeros(0)


def mel_to_audio(m: np.ndarray, sr: int = 22050, n_fft: int = 2048, hop: int = 512, rounds: int = 32, momentum: float = 0.99, seed: int = 0) -> np.ndarray:
    """Non-negative inversion of the mel bank by multiplicative steps, then fast Griffin-Lim."""
    bank = mel_bank(sr, n_fft, m.shape[0])
    power = np.maximum(np.linalg.pinv(bank) @ m, 1e-10)
    for _ in range(20):
        power *= (bank.T @ m) / np.maximum(bank.T @ (bank @ power), 1e-12)
    size = np.sqrt(power)
    rng = np.random.default_rng(seed)
    phase, before = np.exp(2j * np.pi * rng.random(size.shape)), np.zeros(size.shape, complex)
    for _ in range(rounds):
        again = stft(istft(size * phase, hop), n_fft, hop)[:, : size.shape[1]]
        again = np.pad(again, ((0, 0), (0, size.shape[1] - again.shape[1])))
        ahead = again - momentum / (1 + momentum) * before
        phase, before = ahead / np.maximum(np.abs(ahead), 1e-16), again
    return istft(size * phase, hop)
