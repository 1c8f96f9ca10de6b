"""Fingerprints of what a stage's result depends on, and the decision whether an earlier result may be used again."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field


def normal_json(value: object) -> object:
    """The value as plain JSON data; an error for numbers that are not finite, keys that are not strings and other types."""
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("a number must be finite")
        return value
    if isinstance(value, Mapping):
        if not all(isinstance(k, str) for k in value):
            raise TypeError("keys must be strings")
        return {k: normal_json(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [normal_json(v) for v in value]
    raise TypeError(f"{type(value).__name__} is not JSON")


def fingerprint(value: object) -> str:
    """SHA-256 of canonical JSON: sorted keys, no spaces, UTF-8."""
    text = json.dumps(normal_json(value), ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class Artifact:
    """A stored table or file by content."""

    artifact_id: str
    uri: str
    size_bytes: int
    sha256: str


@dataclass(frozen=True)
class Task:
    """What a stage is about to do; run ids and places are no part of its key."""

    stage: str
    version: str
    inputs: Mapping[str, Artifact] = field(default_factory=dict)
    config: Mapping[str, object] = field(default_factory=dict)
    models: Mapping[str, str] = field(default_factory=dict)
    schema: str = "1"

    def input_prints(self) -> dict[str, list]:
        return {k: [a.sha256, a.size_bytes] for k, a in self.inputs.items()}

    def cache_key(self) -> str:
        return "stage-cache-v1:" + fingerprint({"cache_schema": "1", "task_schema": self.schema, "stage": self.stage, "stage_version": self.version, "inputs": self.input_prints(), "config": dict(self.config), "model_bindings": dict(self.models)})


@dataclass(frozen=True)
class Manifest:
    """What a stage did."""

    task: Task
    status: str  # succeeded, skipped, failed, cancelled
    outputs: Mapping[str, Artifact] = field(default_factory=dict)
    models: tuple[tuple[str, ...], ...] = ()  # slot, provider, model, revision, runtime
    cache_key: str | None = None


@dataclass(frozen=True)
class Decision:
    status: str  # hit, miss, forced
    cache_key: str
    misses: tuple[tuple[str, str | None], ...] = ()  # reason, subject


# Reasons of a miss that compare tasks, and how each is told.
_TASK_CHANGES: tuple[tuple[str, Callable[[Task], object]], ...] = (
    ("TASK_SCHEMA_CHANGED", lambda t: t.schema),
    ("STAGE_CHANGED", lambda t: t.stage),
    ("STAGE_VERSION_CHANGED", lambda t: t.version),
    ("INPUTS_CHANGED", Task.input_prints),
    ("CONFIG_CHANGED", lambda t: dict(t.config)),
    ("MODEL_BINDINGS_CHANGED", lambda t: dict(t.models)),
)


class CacheEvaluator:
    """verify(artifact) gives None for an artifact whose bytes are as recorded, else NOT_FOUND, SIZE_MISMATCH or CHECKSUM_MISMATCH."""

    def __init__(self, verify: Callable[[Artifact], str | None]):
        self.verify = verify

    def _stored(self, kind: str, artifacts: Mapping[str, Artifact]):
        for name, a in sorted(artifacts.items()):
            try:
                fault = self.verify(a)
            except Exception:  # noqa: BLE001  a store's fault is a reason, not a failure
                fault = "VERIFICATION_FAILED"
            if fault:
                yield f"{kind}_{fault}", name

    def decide(self, task: Task, manifest: Manifest | None, models: tuple[tuple[str, ...], ...] | None = None, force: bool = False) -> Decision:
        key = task.cache_key()
        if force:
            return Decision("forced", key, (("FORCE_REQUESTED", None),))
        if manifest is None:
            return Decision("miss", key, (("MANIFEST_NOT_FOUND", None),))
        out: list[tuple[str, str | None]] = [(reason, None) for reason, part in _TASK_CHANGES if part(manifest.task) != part(task)]
        if manifest.cache_key != key:
            out.append(("CACHE_KEY_MISSING" if manifest.cache_key is None else "CACHE_KEY_MISMATCH", None))
        if manifest.status != "succeeded":
            out.append(("SKIPPED_RECHECK_REQUIRED" if manifest.status == "skipped" else "RESULT_NOT_CACHEABLE", None))
        if task.models and models is None:
            out.append(("EFFECTIVE_MODELS_UNAVAILABLE", None))
        elif sorted(manifest.models) != sorted(models or ()):
            out.append(("EFFECTIVE_MODELS_CHANGED", None))
        if manifest.status == "succeeded":
            out += self._stored("INPUT", task.inputs)
            out += self._stored("OUTPUT", manifest.outputs)
        return Decision("miss" if out else "hit", key, tuple(out))
