"""Acoustic figures of sample arrays: levels as Column expressions, spectra by Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Clipping level, activity level (-50 dB), analysis rate, high band, roll-off share.
CLIP, ACTIVE, MAX_RATE, HIGH_HZ, ROLLOFF = 0.999, 10 ** (-50 / 20), 24000, 4000.0, 0.85
SPECTRUM = "rms_db double, clipping_fraction double, spectral_centroid_hz double, spectral_rolloff_85_hz double, high_frequency_ratio_4khz double"


def sample_stats(x: Column, rate: int = 48000, active: float = ACTIVE) -> Column:
    """duration_seconds, peak, clipping_fraction, rms, rms_db, leading and trailing silence.

    Squares are rounded to float and summed in double; an array without active samples is
    silent from both ends; an empty or null one has zeros and -240 dB.
    """
    n = F.coalesce(F.size(F.filter(x, lambda v: v.isNotNull())), F.lit(0))
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + (v * v).cast("float").cast("double"))
    rms = F.when(n > 0, F.sqrt(total / n)).otherwise(F.lit(0.0))
    loud = F.filter(F.transform(x, lambda v, i: F.when(F.abs(v) >= F.lit(active).cast("float"), i)), lambda i: i.isNotNull())
    first, last, ms = F.array_min(loud), F.array_max(loud), 1000.0 / rate
    clipped = F.size(F.filter(x, lambda v: F.abs(v) >= F.lit(CLIP).cast("float")))
    return F.struct(
        (n / rate).alias("duration_seconds"), F.coalesce(F.array_max(F.transform(x, lambda v: F.abs(v))).cast("double"), F.lit(0.0)).alias("peak"),
        F.when(n > 0, clipped / n).otherwise(F.lit(0.0)).alias("clipping_fraction"), rms.alias("rms"), (20 * F.log10(F.greatest(rms, F.lit(1e-12)))).alias("rms_db"),
        F.coalesce(first * ms, n * ms).alias("leading_silence_ms"), F.coalesce((n - 1 - last) * ms, n * ms).alias("trailing_silence_ms"),
    )


def resample(x: np.ndarray, rate: int, to: int = MAX_RATE) -> np.ndarray:
    """Band-limited resampling through the Fourier transform."""
    n = max(1, round(len(x) * to / rate))
    return np.fft.irfft(np.fft.rfft(x)[: n // 2 + 1], n) * (n / len(x))


def spectral_summary(x: np.ndarray, rate: int) -> dict[str, float]:
    """Convention: Hann window, centred frames with zero padding, hop of a quarter window."""
    x = np.asarray(x, np.float32).astype(float)
    if not len(x):
        return dict(rms_db=-240.0, clipping_fraction=0.0, spectral_centroid_hz=0.0, spectral_rolloff_85_hz=0.0, high_frequency_ratio_4khz=0.0)
    if rate > MAX_RATE:
        x, rate = resample(x, rate), MAX_RATE
    n = 2048 if len(x) >= 2048 else 256
    hop = max(64, n // 4)
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(x, n // 2), n)[::hop]
    size = np.abs(np.fft.rfft(frames * np.hanning(n + 1)[:-1], axis=1))
    power, freq = size**2, np.fft.rfftfreq(n, 1 / rate)
    sums, cum = size.sum(axis=1), np.cumsum(size, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        centroid = np.where(sums > 0, size @ freq / sums, 0.0)
    rolloff = freq[np.argmax(cum >= ROLLOFF * sums[:, None], axis=1)]
    rms, total = float(np.sqrt(np.mean(x**2))), power.sum()
    return dict(
        rms_db=20 * float(np.log10(max(rms, 1e-12))), clipping_fraction=float(np.mean(np.abs(x) >= CLIP)), spectral_centroid_hz=float(np.median(centroid)),
        spectral_rolloff_85_hz=float(np.median(rolloff)), high_frequency_ratio_4khz=float(power[:, freq >= HIGH_HZ].sum() / total) if total > 0 else 0.0,
    )


def spectra(samples: Column, rate: int = 48000) -> Column:
    """struct of the whole clip's figures, first_half and second_half (split at max(1, n / 2))."""

    @F.pandas_udf(f"{SPECTRUM}, first_half struct<{SPECTRUM.replace(' double', ':double')}>, second_half struct<{SPECTRUM.replace(' double', ':double')}>")
    def run(clips: pd.Series) -> pd.DataFrame:
        out = []
        for c in clips:
            x = np.asarray(c if c is not None else [], np.float32)
            at = max(1, len(x) // 2)
            out.append(spectral_summary(x, rate) | {"first_half": spectral_summary(x[:at], rate), "second_half": spectral_summary(x[at:], rate)})
        return pd.DataFrame(out)

    return run(samples)
