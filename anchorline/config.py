"""Settings: defaults, level profiles and overrides merged one level deep."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any


@dataclass(frozen=True)
class Segmentation:
    target_s: float = 30
    max_clip_s: float = 40
    min_tail_s: float = 12


@dataclass(frozen=True)
class Windows:
    window_ms: int = 6000
    overlap_ms: int = 1000
    cut_tolerance_ms: int = 1500
    max_anchors: int = 40


@dataclass(frozen=True)
class Snap:
    version: int = 2
    sfx_ms: int = 250
    bed_ms: int = 600
    audibility_ms: int = 150
    impact_gap_ms: int = 150
    dedupe_ms: int = 40
    near_cut_ms: int = 300
    assign_window_ms: int = 400
    max_cost: float = 0.85
    weights: tuple[float, ...] = (0.45, 0.30, 0.15, 0.10)


@dataclass(frozen=True)
class Fusion:
    cluster_ms: int = 40
    visual_attach_ms: int = 100
    weights: tuple[float, ...] = (0.35, 0.30, 0.15, 0.15, 0.05)


@dataclass(frozen=True)
class Flags:
    separation: bool = False
    windowed_proposer: bool = False
    audio_only_pass: bool = False
    judge: bool = False
    visual_v2: bool = True
    snap_v2: bool = True


@dataclass(frozen=True)
class Config:
    level: str = "low"
    segmentation: Segmentation = field(default_factory=Segmentation)
    windows: Windows = field(default_factory=Windows)
    snap: Snap = field(default_factory=Snap)
    fusion: Fusion = field(default_factory=Fusion)
    flags: Flags = field(default_factory=Flags)


HIGH = Flags(separation=True, windowed_proposer=True, audio_only_pass=True, judge=True)


def load(level: str | None = None, overrides: Mapping[str, Any] | None = None) -> Config:
    """The profile of a level ("high" or else "low") with overrides; unknown keys are left out."""
    high = (level or "").strip().lower() == "high"
    out = Config(level="high" if high else "low", flags=HIGH if high else Flags())
    for part, values in (overrides or {}).items():
        if part in {f.name for f in fields(out)} - {"level"} and isinstance(values, Mapping):
            now = getattr(out, part)
            known = {f.name for f in fields(now)}
            out = replace(out, **{part: replace(now, **{k: v for k, v in values.items() if k in known})})
    version = 1 if not out.flags.snap_v2 else max(2, out.snap.version)
    return replace(out, snap=replace(out.snap, version=version))
