"""Thresholds of the analysis, all in one place and always overridable."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # fixed values: floors and bounds of the published figures
    min_evaluable: int = 30
    min_polities: int = 2
    band_tolerance: float = 0.005
    edge_floor: float = 0.55
    threshold_hi: float = 0.95
    threshold_step: float = 0.01
    theme_share: float = 0.05
    story_share: float = 0.35
    min_theme: int = 8
    min_story: int = 5
    rounds: int = 2000
    powered_sources: int = 50
    powered_polities: int = 4
    thin: int = 3
    span_hours: int = 24
    series_hours: int = 168
    series_points: int = 60
    series_days: int = 90
    containment: float = 0.5
    featured: int = 5


DEFAULT = Params()
