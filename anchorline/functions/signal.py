"""Signal kernels for one clip at a time (NumPy), and their grouped form over a table of clips.

Onsets: band-wise flux of log magnitudes over two frames, each band compared with its
neighbours in frequency, picked where they stand out of the median by deviations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bands in Hz, lower edge inside, upper edge outside.
BANDS = {"lf": (0, 500), "lowmid": (500, 2000), "mid": (2000, 8000), "hf": (8000, 16000)}
HOP, FRAME, LAG = 160, 1024, 2


def magnitudes(x: np.ndarray, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """frames x frequencies; frame i is centred on sample i * hop."""
    padded = np.pad(np.asarray(x, np.float64), frame // 2)
    n = 1 + max(0, len(padded) - frame) // hop
    view = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop][:n]
    return np.abs(np.fft.rfft(view * np.hanning(frame), axis=1))


def band_flux(mag: np.ndarray, sr: int, band: tuple[int, int]) -> np.ndarray:
    """Sum of rises of a band's log magnitudes over the widest of three old neighbours; first frames 0."""
    f = np.fft.rfftfreq(FRAME, 1 / sr)
    level = np.log1p(1000 * mag[:, (f >= band[0]) & (f < band[1])])
    if level.shape[1] == 0 or len(level) <= LAG:
        return np.zeros(len(mag))
    wide = np.maximum(level, np.maximum(np.pad(level, ((0, 0), (1, 0)), "edge")[:, :-1], np.pad(level, ((0, 0), (0, 1)), "edge")[:, 1:]))
    rise = np.maximum(level[LAG:] - wide[:-LAG], 0).sum(axis=1)
    return np.concatenate([np.zeros(LAG), rise])


def stand_out(env: np.ndarray, half: int, k: float, gap: int) -> list[int]:
    """Local maxima over median plus k deviations of their surroundings; of two within the gap the stronger."""
    kept: list[int] = []
    for i in range(1, len(env) - 1):
        if env[i] < env[i - 1] or env[i] < env[i + 1]:
            continue
        near = env[max(0, i - half) : i + half + 1]
        mid = np.median(near)
        if env[i] < mid + k * (np.median(np.abs(near - mid)) + 1e-9):
            continue
        if kept and i - kept[-1] < gap:
            if env[i] > env[kept[-1]]:
                kept[-1] = i
        else:
            kept.append(i)
    return kept


def level_db(x: np.ndarray, sr: int, smooth_ms: float = 2.0) -> np.ndarray:
    """The moving mean of magnitudes in dB; unlike an analytic signal's it has no tails that reach into silence."""
    width = max(1, round(smooth_ms * sr / 1000))
    return 20 * np.log10(np.convolve(np.abs(x), np.ones(width) / width, "same") + 1e-10) if len(x) else np.zeros(0)


def rise_start(level: np.ndarray, peak: int, floor: float, edge: int, margin_db: float) -> float:
    """Where the line through the middle of the rise to ``peak`` meets the floor, between ``edge`` and the peak.

    The rise begins after the last sample near the floor; the line is the least-squares one through its samples
    from a tenth to nine tenths of the height.
    """
    near = np.flatnonzero(level[edge : peak + 1] < floor + margin_db)
    start = edge + int(near[-1]) if len(near) else edge
    height = level[peak] - floor
    above, below = np.flatnonzero(level[start : peak + 1] >= floor + 0.1 * height), np.flatnonzero(level[start : peak + 1] <= floor + 0.9 * height)
    first = start + int(above[0]) if len(above) else start
    last = max(start + int(below[-1]), first + 1) if len(below) else peak
    if last <= first:
        return float(max(start, edge))
    y = level[first : last + 1]
    if len(y) < 2 or y.std() <= 1e-6:
        return float(first)
    slope, at = np.polyfit(np.arange(first, first + len(y)), y, 1)
    return float(np.clip((floor - at) / slope, edge, peak)) if abs(slope) > 1e-9 else float(first)


def refine(x: np.ndarray, sr: int, at_ms: float, margin_db: float = 6.0, back_ms: float = 40.0) -> dict:
    """An onset's start by its rise: t_ms_f, rise_time_ms, peak_db, floor_db, snr_db, low_confidence and the peak's sample.

    A start more than ``back_ms`` before the coarse time is drawn to the peak; one more than 30 ms from it is given up.
    """
    i = lambda ms: int(np.clip(round(ms * sr / 1000), 0, len(x)))
    lo, hi = i(at_ms - 120), i(at_ms + 60)
    if hi - lo < max(8, sr // 100):
        return {"t_ms_f": at_ms, "rise_time_ms": None, "peak_db": None, "floor_db": None, "snr_db": 0.0, "low_confidence": True, "peak": i(at_ms)}
    level = level_db(x[lo:hi], sr)
    peak = int(level.argmax())
    before = x[i(at_ms - 300) : i(at_ms - 100)]
    floor = np.percentile(level_db(before, sr), 10) if len(before) > 16 else level.min()
    floor = max(float(floor), float(level[peak]) - 60)
    x0 = rise_start(level, peak, floor, max(0, peak - round(back_ms * sr / 1000)), margin_db)
    t, peak_ms = (lo + x0) * 1000 / sr, (lo + peak) * 1000 / sr
    if t < at_ms - back_ms:
        t = at_ms - back_ms
        if abs(peak_ms - at_ms) <= 25:
            t = peak_ms if peak - x0 <= max(2, sr // 500) else min(t, peak_ms)
    if abs(t - at_ms) > 30:
        t = at_ms
    snr = float(level[peak]) - floor
    return {"t_ms_f": float(t), "rise_time_ms": max(0.0, peak_ms - t), "peak_db": float(level[peak]), "floor_db": floor, "snr_db": snr, "low_confidence": snr < margin_db, "peak": lo + peak}


def offset(x: np.ndarray, sr: int, onset: dict, cap_ms: float, next_ms: float | None = None) -> tuple[float, bool]:
    """(end in ms, reliable) of a refined onset: the first sample after its peak that is 30 dB down or near the floor."""
    start, peak = onset["t_ms_f"], onset["peak"]
    most = cap_ms if next_ms is None else min(cap_ms, max(1000 / sr, next_ms - start))
    part = x[peak : peak + round(most * sr / 1000)]
    if len(part) < 4:
        return start + 30, False
    level = level_db(part, sr)
    top = onset["peak_db"] if onset["peak_db"] is not None else float(level[0])
    floor = onset["floor_db"] if onset["floor_db"] is not None else top - 40
    under = np.flatnonzero(level[1:] < max(floor + 6, top - 30))
    last = 1 + int(under[0]) if len(under) else len(level) - 1
    crowded = next_ms is not None and start + last * 1000 / sr >= next_ms - 5
    return (peak + last) * 1000 / sr, bool(len(under)) and not crowded and not onset["low_confidence"]


def onsets(x: np.ndarray, sr: int = 32_000, k: float = 3.5, merge_ms: float = 25.0) -> list[dict]:
    """Onsets of all bands, merged when near: time, bands, strength, SNR and end."""
    x = np.asarray(x, np.float64)
    mag = magnitudes(x)
    half, per_ms = max(3, round(0.6 * sr / HOP) // 2), HOP * 1000 / sr
    found = []
    for name, band in BANDS.items():
        env = band_flux(mag, sr, band)
        top = env.max(initial=0)
        gap = round((20 if name == "hf" else 35) / per_ms)
        found += [(i * per_ms, float(env[i] / top), name) for i in (stand_out(env, half, k, gap) if top > 0 else [])]
    merged: list[dict] = []
    for t, s, name in sorted(found):
        if merged and t - merged[-1]["t_ms_coarse"] <= merge_ms:
            m = merged[-1]
            m["bands"] = sorted({*m["bands"], name})
            if s > m["strength"]:
                m |= {"t_ms_coarse": t, "strength": s}
        else:
            merged.append({"t_ms_coarse": t, "strength": s, "bands": [name]})
    for m in merged:
        m |= refine(x, sr, m["t_ms_coarse"])
        m["uncertainty_ms"] = 40.0 if m["low_confidence"] else max(4.0, m["rise_time_ms"] or 8.0)
    for m, following in zip(merged, [*merged[1:], None], strict=True):
        cap = 1500 if {"hf", "mid"} & {*m["bands"]} else 3000
        m["t_end_ms_f"], m["end_reliable"] = offset(x, sr, m, cap, following["t_ms_f"] if following else None)
        m["decay_ms"] = m["t_end_ms_f"] - m["t_ms_f"]
    return merged


ONSETS = "clip string, t_ms_f double, t_ms_coarse double, strength double, bands array<string>, snr_db double, low_confidence boolean, rise_time_ms double, uncertainty_ms double, t_end_ms_f double, decay_ms double, end_reliable boolean"


def detect_onsets(clips: DataFrame, sr: int = 32_000) -> DataFrame:
    """Onset rows of a table (clip, samples array<float>); one clip's samples are one row."""
    names = [x.split()[0] for x in ONSETS.split(", ")]

    def run(batches):
        for b in batches:
            for clip, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = onsets(x.values.to_numpy(), sr) if x.is_valid and len(x) else []
                table = {n: [r[n] for r in rows] for n in names[1:]}
                yield pa.RecordBatch.from_pydict({"clip": [clip] * len(rows), **table}, schema=schema)

    schema = pa.schema([("clip", pa.string()), ("t_ms_f", pa.float64()), ("t_ms_coarse", pa.float64()), ("strength", pa.float64()), ("bands", pa.list_(pa.string())), ("snr_db", pa.float64()), ("low_confidence", pa.bool_()), ("rise_time_ms", pa.float64()), ("uncertainty_ms", pa.float64()), ("t_end_ms_f", pa.float64()), ("decay_ms", pa.float64()), ("end_reliable", pa.bool_())])
    return clips.select("clip", "samples").mapInArrow(run, ONSETS)
