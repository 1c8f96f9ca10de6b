"""Settings of a run, spread over its stages, and checks before a run."""

from __future__ import annotations

import importlib.util
import sys
from dataclasses import dataclass

from .errors import ContractError


@dataclass(frozen=True)
class PipelineSettings:
    scene_threshold: float = 27.0
    max_keyframes_per_scene: int = 3
    speech_max_gap_sec: float = 0.5
    audio_window_sec: float = 5.0
    audio_hop_sec: float = 2.5
    audio_events_enabled: bool = True
    audio_min_confidence: float = 0.5
    ocr_mode: str = "caption-hints"
    ocr_min_confidence: float = 0.5
    max_context_tokens: int | None = None
    min_similarity: float = 0.35

    def __post_init__(self):
        if self.ocr_mode not in ("disabled", "caption-hints", "all"):
            raise ContractError("ocr_mode is disabled, caption-hints or all")
        if not 0 < self.audio_hop_sec <= self.audio_window_sec or not 1 <= self.max_keyframes_per_scene <= 3:
            raise ContractError("a setting is out of bounds")

    def stage_configs(self) -> dict[str, dict[str, object]]:
        return {
            "02_scenes": {"threshold": self.scene_threshold},
            "03_keyframes": {"max_keyframes_per_scene": self.max_keyframes_per_scene},
            "05_audio_events": {"enabled": self.audio_events_enabled, "window_sec": self.audio_window_sec, "hop_sec": self.audio_hop_sec, "min_confidence": self.audio_min_confidence},
            "06_stt": {"max_gap_sec": self.speech_max_gap_sec},
            "08_ocr": {"mode": self.ocr_mode, "min_confidence": self.ocr_min_confidence},
            "11_context": {"max_context_tokens": self.max_context_tokens},
        }


def preflight(modules: tuple[str, ...] = ("pyspark", "pyarrow", "pandas", "numpy"), python: tuple[int, int] = (3, 10)) -> dict[str, str]:
    """What is missing or too old; empty when all is well."""
    out = {m: "missing" for m in modules if importlib.util.find_spec(m) is None}
    if sys.version_info[:2] < python:
        out["python"] = f"older than {python[0]}.{python[1]}"
    return out
