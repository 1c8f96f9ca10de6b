"""Models behind one gateway: aliases, admission, deadlines, and batched calls from executors.

A provider is a callable on a batch of inputs. `Gateway.infer` calls one at the driver; `model_column` calls one for a DataFrame's rows
in Arrow batches on the executors, where rows travel with their key, so answers never have to be matched by place.
"""

from __future__ import annotations

import hashlib
import math
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TASKS = ("vad", "stt", "diarization", "caption", "ocr", "audio_event", "embedding")


@dataclass(frozen=True)
class Capabilities:
    tasks: tuple[str, ...]
    aliases: tuple[str, ...]
    max_batch: int = 32
    max_bytes: int = 1 << 30


class Provider(Protocol):
    def capabilities(self) -> Capabilities: ...

    def infer(self, task: str, inputs: Sequence, params: dict) -> Sequence: ...

    def cancel(self, request_id: str) -> bool: ...

    def health(self) -> bool: ...


@dataclass
class Response:
    status: str  # succeeded, failed
    outputs: Sequence = ()
    reason: str | None = None
    seconds: float = 0.0


@dataclass
class CircuitBreaker:
    """Opens after so many failures on end, and lets one call through after a while."""

    failures: int = 5
    open_sec: float = 30.0
    clock: Callable[[], float] = time.monotonic
    count: int = 0
    opened: float | None = None

    def allow(self) -> bool:
        return self.opened is None or self.clock() - self.opened >= self.open_sec

    def success(self) -> None:
        self.count, self.opened = 0, None

    def failure(self) -> None:
        self.count += 1
        if self.count >= self.failures:
            self.opened = self.clock()


@dataclass
class Gateway:
    providers: dict[str, Provider]
    breakers: dict[str, CircuitBreaker] = field(default_factory=dict)

    def admit(self, alias: str, task: str, inputs: Sequence, sizes: Sequence[int] = ()) -> str | None:
        """Why a request is not let in, or None."""
        if alias not in self.providers:
            return "UNKNOWN_MODEL_ALIAS"
        c = self.providers[alias].capabilities()
        if task not in TASKS or task not in c.tasks or alias not in c.aliases:
            return "UNSUPPORTED_TASK"
        if not inputs or len(inputs) > c.max_batch:
            return "BATCH_TOO_LARGE" if inputs else "EMPTY_BATCH"
        if any(s > c.max_bytes for s in sizes):
            return "ARTIFACT_TOO_LARGE"
        return None

    def infer(self, alias: str, task: str, inputs: Sequence, params: dict | None = None, sizes: Sequence[int] = (), deadline_sec: float | None = None) -> Response:
        if reason := self.admit(alias, task, inputs, sizes):
            return Response("failed", reason=reason)
        breaker = self.breakers.setdefault(alias, CircuitBreaker())
        if not breaker.allow():
            return Response("failed", reason="PROVIDER_UNAVAILABLE")
        began = time.monotonic()
        pool = ThreadPoolExecutor(1)
        try:
            out = pool.submit(self.providers[alias].infer, task, inputs, params or {}).result(deadline_sec)
        except Late:
            breaker.failure()
            return Response("failed", reason="DEADLINE_EXCEEDED", seconds=time.monotonic() - began)
        except Exception as e:  # noqa: BLE001  a provider's fault becomes a reason
            breaker.failure()
            return Response("failed", reason=f"PROVIDER_ERROR:{type(e).__name__}", seconds=time.monotonic() - began)
        finally:
            pool.shutdown(wait=False)
        breaker.success()
        if len(out) != len(inputs):
            return Response("failed", reason="OUTPUT_COUNT_MISMATCH", seconds=time.monotonic() - began)
        return Response("succeeded", out, seconds=time.monotonic() - began)


def model_column(rows: DataFrame, inputs: str, output: str, kind: str | T.DataType, load: Callable[[], Callable[[list], list]], batch: int = 32) -> DataFrame:
    """Rows with the model's answer for a column. `load` makes the model once for each task; a batch's answers must be as many as its inputs."""
    kind = kind if isinstance(kind, str) else kind.simpleString()
    schema = T.StructType([*rows.schema.fields]).simpleString()[len("struct<") : -1] + f",{output}:{kind}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            answers: list = []
            for at in range(0, len(pdf), batch):
                part = pdf[inputs].iloc[at : at + batch].tolist()
                got = model(part)
                if len(got) != len(part):
                    raise ValueError("a model gave another number of answers than inputs")
                answers += got
            yield pdf.assign(**{output: answers})

    return rows.mapInPandas(run, ", ".join(f"`{c.split(':', 1)[0].strip('`')}` {c.split(':', 1)[1]}" for c in _fields(schema)))


def _fields(text: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">") + (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(text[at:i])
            at = i + 1
    return [*out, text[at:]]


def hashed_embedding(texts: list[str], size: int = 64) -> list[list[float]]:
    """A deterministic stand-in for an embedding model: signed word hashes, unit length. Blank texts are refused."""
    out = []
    for t in texts:
        if not t.strip():
            raise ValueError("a text to embed must not be blank")
        v = [0.0] * size
        for w in t.lower().split():
            h = hashlib.sha256(w.encode()).digest()
            v[h[0] % size] += 1.0 if h[1] % 2 else -1.0
        length = math.sqrt(sum(x * x for x in v)) or 1.0
        out.append([x / length for x in v] if any(v) else [1.0] + [0.0] * (size - 1))
    return out
