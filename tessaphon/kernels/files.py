"""WAV, AIFF and NPZ bytes, without Spark."""

from __future__ import annotations

import io
import struct
import wave

import numpy as np

from .spectral import resample


def decode_wav(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and samples in -1..1, channels by samples."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, raw = w.getsampwidth(), w.getnchannels(), w.readframes(w.getnframes())
        rate = w.getframerate()
    if width == 1:
        y = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        y = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        y = np.frombuffer(raw, f"<i{width}").astype(np.float32) / (1 << (8 * width - 1))
    return rate, y.reshape(-1, channels).T


def _extended(data: bytes) -> float:
    """The 80-bit number that AIFF gives the rate in."""
    exponent, mantissa = struct.unpack(">HQ", data)
    return mantissa * 2.0 ** ((exponent & 0x7FFF) - 16383 - 63)


def decode_aiff(content: bytes) -> tuple[int, np.ndarray]:
    """As decode_wav, of AIFF and of uncompressed AIFF-C."""
    if content[:4] != b"FORM" or content[8:12] not in (b"AIFF", b"AIFC"):
        raise ValueError("not an AIFF file")
    at, head, body = 12, None, b""
    while at + 8 <= len(content):
        kind, size = struct.unpack(">4sI", content[at : at + 8])
        if kind == b"COMM":
            head = content[at + 8 : at + 8 + size]
        elif kind == b"SSND":
            skip = struct.unpack(">I", content[at + 8 : at + 12])[0]
            body = content[at + 16 + skip : at + 8 + size]
        at += 8 + size + size % 2
    if head is None:
        raise ValueError("an AIFF file without a COMM chunk")
    channels, count, bits = struct.unpack(">hIh", head[:8])
    coding = head[18:22] if content[8:12] == b"AIFC" else b"NONE"
    if coding not in (b"NONE", b"twos", b"sowt", b"fl32", b"FL32"):
        raise ValueError(f"no decoder for AIFF-C of the kind {coding!r}")
    width, order = (bits + 7) // 8, "<" if coding == b"sowt" else ">"
    body = body[: count * channels * width]
    if coding in (b"fl32", b"FL32"):
        y = np.frombuffer(body, ">f4").astype(np.float32)
    elif width == 3:
        b = np.frombuffer(body, np.uint8).reshape(-1, 3).astype(np.int32)[:, :: 1 if order == "<" else -1]
        y = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        y = np.frombuffer(body, f"{order}i{width}").astype(np.float32) / (1 << (8 * width - 1))
    return round(_extended(head[8:18])), y.reshape(-1, channels).T


#: Decoders by suffix: bytes to (rate, channels by samples). Others can be registered here.
DECODERS = {".wav": decode_wav, ".aiff": decode_aiff, ".aif": decode_aiff}


def load(content: bytes, suffix: str, sample_rate: int | None, mono: bool, offset_sec: float = 0.0, duration_sec: float | None = None):
    """Rate, native rate, native samples, channels by samples: cut, mixed down, resampled."""
    if suffix not in DECODERS:
        raise ValueError(f"no decoder for {suffix or 'files without suffix'}")
    native, y = DECODERS[suffix](content)
    total = y.shape[1]
    first = int(round(offset_sec * native))
    y = y[:, first : None if duration_sec is None else first + int(round(duration_sec * native))]
    if mono:
        y = y.mean(axis=0, keepdims=True)
    rate = sample_rate or native
    if rate != native:
        y = np.stack([resample(c, rate / native, int(np.ceil(y.shape[1] * rate / native))) for c in y])
    return rate, native, total, y.astype(np.float32)


def encode_wav(y, sr: int) -> bytes:
    """16-bit PCM of a mono sound."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes(np.clip(np.round(np.asarray(y, float) * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def write_npz(arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def read_npz(content: bytes, explode_leading: bool = False) -> list[np.ndarray]:
    """Arrays in the archive's order; of older archives, the entries of each array's leading axis."""
    with np.load(io.BytesIO(content), allow_pickle=False) as held:
        arrays = [held[k] for k in held.files]
    if explode_leading:
        arrays = [x for a in arrays for x in (a if a.ndim == 3 else [a])]
    return arrays
