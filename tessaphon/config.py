"""Settings that a driver program passes to sources and kernels."""

from __future__ import annotations

from dataclasses import dataclass

# What archives of features that are already there were made with, so that new ones can stand beside them:
# samples a second, samples of a window, samples from one frame to the next, mel bands.
RATE, WINDOW, STEP, BANDS = 22050, 2048, 256, 256


@dataclass(frozen=True, kw_only=True)
class Decoding:
    """How files become samples: rate (None: their own), whether channels are mixed into one, the part of a file in seconds."""

    rate: int | None = RATE
    mixed: bool = True
    start: float = 0.0
    seconds: float | None = None


@dataclass(frozen=True, kw_only=True)
class Spectrum:
    """How samples become frames: the rate that frequencies are reckoned by, window, transform (None: as the window), step, bands, centring."""

    rate: int = RATE
    window: int = WINDOW
    padded: int | None = None
    step: int = STEP
    bands: int = BANDS
    centred: bool = True

    @property
    def size(self) -> int:
        return self.padded or self.window
