"""Stages as data, their registry, and plans over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from .errors import PlanError


@dataclass(frozen=True)
class StageSpec:
    name: str
    version: str = "1.0.0"
    after: tuple[str, ...] = ()
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    optional_inputs: tuple[str, ...] = ()
    models: tuple[str, ...] = ()
    config: Mapping[str, object] = field(default_factory=dict)


class StageRegistry:
    """Stages with unique names and outputs and known dependencies."""

    def __init__(self, specs: Iterable[StageSpec]):
        self._by_name: dict[str, StageSpec] = {}
        self._owner: dict[str, str] = {}
        for s in specs:
            if s.name in self._by_name:
                raise PlanError(f"two stages are named {s.name}")
            self._by_name[s.name] = s
            for o in s.outputs:
                if o in self._owner:
                    raise PlanError(f"{o} is the output of {self._owner[o]} and of {s.name}")
                self._owner[o] = s.name
        for s in self._by_name.values():
            if unknown := set(s.after) - set(self._by_name):
                raise PlanError(f"{s.name} follows unknown stages: {', '.join(sorted(unknown))}")

    def __getitem__(self, name: str) -> StageSpec:
        try:
            return self._by_name[name]
        except KeyError:
            raise PlanError(f"no stage is named {name}") from None

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self._by_name)

    def owner(self, table: str) -> str | None:
        return self._owner.get(table)

    @property
    def external_inputs(self) -> tuple[str, ...]:
        need = {i for s in self._by_name.values() for i in (*s.inputs, *s.optional_inputs)}
        return tuple(sorted(need - set(self._owner)))


@dataclass(frozen=True)
class ExecutionPlan:
    stages: tuple[str, ...]
    boundary_inputs: tuple[str, ...]


class Planner:
    """Orders stages; among those that are ready, the first by name goes next, whatever the order of registration."""

    def __init__(self, registry: StageRegistry):
        self.registry = registry
        sorter = TopologicalSorter({n: registry[n].after for n in registry.names})
        try:
            sorter.prepare()
        except CycleError as e:
            raise PlanError(f"stages depend on one another: {' -> '.join(e.args[1])}") from None
        order, ready = [], set()
        while sorter.is_active():
            ready |= set(sorter.get_ready())
            first = min(ready)
            ready.remove(first)
            order.append(first)
            sorter.done(first)
        self.order = tuple(order)
        for n in self.order:
            for i in registry[n].inputs:
                owner = registry.owner(i)
                if owner and owner not in self.ancestors(n):
                    raise PlanError(f"{n} reads {i}, but does not follow {owner}")

    def _reach(self, name: str, forward: bool) -> set[str]:
        found: set[str] = set()
        edge = {name}
        while edge:
            step = {x for x in self.order for y in edge if (y in self.registry[x].after if forward else x in self.registry[y].after)}
            edge = step - found
            found |= step
        return found

    def ancestors(self, name: str) -> set[str]:
        return self._reach(name, False)

    def descendants(self, name: str) -> set[str]:
        return self._reach(name, True)

    def plan(self, stage: str | None = None, start: str | None = None, end: str | None = None) -> ExecutionPlan:
        """One stage, or those from `start` on, up to `end`, or between both."""
        if stage and (start or end):
            raise PlanError("a single stage takes no range")
        chosen = set(self.order)
        if stage:
            chosen = {self.registry[stage].name}
        if start:
            chosen &= {self.registry[start].name} | self.descendants(start)
        if end:
            chosen &= {self.registry[end].name} | self.ancestors(end)
        if not chosen:
            raise PlanError("no stage lies in the range")
        made: set[str] = set()
        need: set[str] = set()
        for n in (n for n in self.order if n in chosen):
            need |= set(self.registry[n].inputs) - made
            made |= set(self.registry[n].outputs)
        return ExecutionPlan(tuple(n for n in self.order if n in chosen), tuple(sorted(need)))


# The stages of a run, what they follow, read and make.
DEFAULT_STAGES = (
    StageSpec("01_probe", "1.0.0", (), ("video",), ("metadata",)),
    StageSpec("02_scenes", "1.0.0", ("01_probe",), ("video", "metadata"), ("scenes", "scene_stats")),
    StageSpec("03_keyframes", "1.3.0", ("02_scenes",), ("video", "scenes"), ("keyframes", "keyframe_images")),
    StageSpec("04_audio", "1.0.0", ("01_probe",), ("video", "metadata"), ("audio", "audio_metadata")),
    StageSpec("04_embedded_text", "1.0.0", ("01_probe",), ("video", "metadata"), ("embedded_text",)),
    StageSpec("05_audio_events", "1.0.0", ("04_audio",), ("audio", "audio_metadata"), ("audio_events",), models=("audio_event",)),
    StageSpec("05_vad", "1.0.0", ("04_audio",), ("audio", "audio_metadata"), ("speech_segments",), models=("vad",)),
    StageSpec("06_stt", "1.0.0", ("04_audio", "05_vad"), ("audio", "speech_segments"), ("transcript",), models=("stt",)),
    StageSpec("07_diarize", "1.0.0", ("04_audio",), ("audio",), ("speaker_turns",), models=("diarization",)),
    StageSpec("08_captions", "1.0.0", ("03_keyframes",), ("keyframes", "keyframe_images"), ("captions",), models=("caption",)),
    StageSpec("08_ocr", "1.0.0", ("03_keyframes", "08_captions"), ("keyframes", "keyframe_images", "captions"), ("ocr",), models=("ocr",)),
    StageSpec("09_timeline", "1.0.0", ("02_scenes", "03_keyframes", "04_embedded_text", "05_audio_events", "06_stt", "07_diarize", "08_captions", "08_ocr"), ("scenes", "keyframes", "embedded_text", "audio_events", "transcript", "speaker_turns", "captions", "ocr"), ("timeline",)),
    StageSpec("10_index", "1.0.0", ("09_timeline",), ("timeline",), ("index",), models=("embedding",)),
    StageSpec("11_context", "1.0.0", ("01_probe", "07_diarize", "09_timeline"), ("metadata", "speaker_turns", "timeline"), ("context",)),
)
#: What stages of selected scenes read besides: the selection, and the results they lay theirs over.
OVERLAID = {"03_keyframes": ("selected_scenes", "source_keyframes"), "08_captions": ("selected_scenes", "source_captions"), "08_ocr": ("selected_scenes", "source_ocr")}
#: Stages that are run again for selected scenes.
DERIVED_STAGES = tuple(StageSpec(s.name, s.version, tuple(a for a in s.after if a in {"03_keyframes", "08_captions", "08_ocr", "09_timeline"}), s.inputs, s.outputs, OVERLAID.get(s.name, ()), s.models) for s in DEFAULT_STAGES if s.name in {"03_keyframes", "08_captions", "08_ocr", "09_timeline", "10_index", "11_context"})
