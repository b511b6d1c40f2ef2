"""Settings of the engine, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    template: int = 56
    stride: int = 11
    low_complexity_window: int = 50
    low_complexity_entropy: float = 4.5
    high_occurrence_window: int = 20
    high_occurrence_hits: int = 10_000
    min_identity_pct: int = 40
    coalesce_gap: int = 100
    line_width: int = 80
    min_n_run: int = 10
    min_piece: int = 100
    clean_min_length: int = 200
    chimeric_window: int = 2000
    chimeric_terminal: int = 500
    chimeric_pct: int = 50
    taxa_shown: int = 4
    signature_threshold: float = 0.3
    min_scores: tuple[int, int, int] = (30, 25, 40)


DEFAULT = EngineConfig()
