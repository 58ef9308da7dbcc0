"""Kernels as Arrow-vectorised UDFs, and the registry of feature kinds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..config import RATE, Spectrum
from . import spectral

FEATURE = "shape array<int>, dtype string, re array<float>, im array<float>"


def _features(kernel):
    @F.pandas_udf(FEATURE)
    def feature(sounds: pd.Series) -> pd.DataFrame:
        out = []
        for y in sounds:
            x = kernel(np.asarray([] if y is None else y, float))
            real = not np.iscomplexobj(x)
            out.append((list(x.shape), "float32" if real else "complex64", x.real.astype(np.float32).ravel(), None if real else x.imag.astype(np.float32).ravel()))
        return pd.DataFrame(out, columns=["shape", "dtype", "re", "im"])

    return feature


#: Feature kinds: spectrum settings to a kernel. Others can be registered here.
KINDS = {
    "stft": lambda how: lambda y: spectral.stft(y, how.size, how.step, how.window, how.centred),
    "mel": lambda how: lambda y: spectral.mel(y, how.rate, how.size, how.step, how.window, how.bands, how.centred),
    "mfcc": lambda how: lambda y: spectral.mfcc(y, RATE),
    "chroma": lambda how: lambda y: spectral.chroma(y, how.rate, how.size, how.step, how.window, PITCHES, how.centred, None),
}
# Fixed value: pitch classes of the chroma kind.
PITCHES = 48


def feature(kind: str, how: Spectrum = Spectrum()):
    """The UDF of a feature kind: ARRAY to STRUCT<shape, dtype, re, im>."""
    if kind not in KINDS:
        raise ValueError(f"unknown feature kind {kind!r}; known are {', '.join(sorted(KINDS))}")
    return _features(KINDS[kind](how))


def framed_power(n_fft: int, hop: int):
    """Magnitudes of uncentred frames: ARRAY to flat ARRAY, frames by bins."""

    @F.pandas_udf("array<double>")
    def power(sounds: pd.Series) -> pd.Series:
        if len(sounds) and all(y is not None and len(y) == len(sounds.iloc[0]) for y in sounds):
            x = np.stack(sounds.to_list()).astype(float)
            f = np.lib.stride_tricks.sliding_window_view(x, n_fft, axis=1)[:, ::hop]
            m = np.abs(np.fft.rfft(f * spectral.hann(n_fft, n_fft), axis=2))
            return pd.Series(list(m.reshape(len(x), -1)))
        return pd.Series([np.abs(spectral.stft(y, n_fft, hop, center=False)).T.ravel() for y in sounds])

    return power


#: Values that a batch of ``flat`` holds before it is sent on, however many rows came in.
SENT = 1 << 21


def flat(kernel, kind: str = "array<double>"):
    """A UDF from a NumPy kernel of one array."""

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sounds in batches:
            out, held = [], 0
            for y in sounds:
                out.append(None if y is None else np.asarray(kernel(np.asarray(y, float))).ravel())
                held += 0 if y is None else out[-1].size
                if held >= SENT:
                    yield pd.Series(out, dtype=object)
                    out, held = [], 0
            yield pd.Series(out, dtype=object)

    return run


def time_stretch(rate: float):
    return flat(lambda y: spectral.time_stretch(y, rate))


def constant_timeframe():
    return flat(spectral.constant_timeframe)


def pitch_shift(sr: int = 22050):
    @F.pandas_udf("array<float>")
    def shift(sounds: pd.Series, steps: pd.Series) -> pd.Series:
        return pd.Series([None if y is None or s is None or s != s else spectral.pitch_shift(y, sr, int(s)).astype(np.float32) for y, s in zip(sounds, steps, strict=True)])

    return shift


def mel_to_audio(sr: int = 22050, n_fft: int = 2048, hop_length: int = 512, seed: int = 0):
    @F.pandas_udf("array<float>")
    def back(values: pd.Series, shapes: pd.Series) -> pd.Series:
        return pd.Series([spectral.mel_to_audio(np.asarray(v, float).reshape(tuple(s)[-2:]), sr, n_fft, hop_length, seed=seed).astype(np.float32) for v, s in zip(values, shapes, strict=True)])

    return back
