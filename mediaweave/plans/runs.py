"""Public runs: created once for each key, limited in number, cancelled, reconciled after a restart, and pruned."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cache import fingerprint
from .engine import CancellationToken, RunResult, now
from .errors import CapacityError, ConflictError, NotFoundError

ACTIVE = ("pending", "running")


class RunService:
    """execute(run_id, request, token) runs a pipeline and gives its result."""

    def __init__(self, execute: Callable[[str, Mapping, CancellationToken], RunResult], capacity: int = 4, keep: int = 100):
        self.execute, self.capacity, self.keep = execute, capacity, keep
        self.runs: dict[str, dict] = {}
        self.keys: dict[str, str] = {}
        self.pool = ThreadPoolExecutor(capacity)
        self.lock = threading.Lock()
        self.futures: dict[str, Future] = {}
        self.tokens: dict[str, CancellationToken] = {}

    def create(self, key: str, request: Mapping) -> tuple[dict, bool]:
        """The run of the key, and whether it is new. The same key with another request is a conflict."""
        print_ = fingerprint(request)
        with self.lock:
            if key in self.keys:
                run = self.runs[self.keys[key]]
                if run["fingerprint"] != print_:
                    raise ConflictError("the key belongs to another request")
                return self.public(run), False
            if sum(r["status"] in ACTIVE for r in self.runs.values()) >= self.capacity:
                raise CapacityError("too many runs are active")
            run_id = f"run_{uuid.uuid4().hex[:20]}"
            self.keys[key] = run_id
            self.runs[run_id] = run = {"run_id": run_id, "key": key, "fingerprint": print_, "status": "pending", "created_at": now(), "updated_at": now(), "completed_at": None, "failure": None, "progress_ratio": 0.0}
            self.tokens[run_id] = CancellationToken()
            self.futures[run_id] = self.pool.submit(self._work, run_id, request)
            return self.public(run), True

    def _work(self, run_id: str, request: Mapping) -> None:
        self._set(run_id, status="running")
        try:
            result = self.execute(run_id, request, self.tokens[run_id])
            failed = next((s for s in result.stages.values() if s.status == "failed"), None)
            self._set(run_id, status=result.status, completed_at=now(), progress_ratio=result.progress, failure=failed and {"stage": failed.stage, "reason": failed.reason})
        except Exception as e:  # noqa: BLE001  the run's record tells of it
            self._set(run_id, status="failed", completed_at=now(), failure={"stage": None, "reason": type(e).__name__})
        self.prune()

    def _set(self, run_id: str, **values) -> None:
        with self.lock:
            self.runs[run_id] |= values | {"updated_at": now()}

    def get(self, run_id: str) -> dict:
        with self.lock:
            if run_id not in self.runs:
                raise NotFoundError(run_id)
            return self.public(self.runs[run_id])

    def cancel(self, run_id: str) -> dict:
        run = self.get(run_id)
        if run["status"] in ACTIVE:
            self.tokens[run_id].cancel()
        return run

    def wait(self, run_id: str, seconds: float | None = None) -> dict:
        if run_id in self.futures:
            self.futures[run_id].result(seconds)
        return self.get(run_id)

    def restore(self, runs: list[dict]) -> None:
        """Takes runs of an earlier process; those that were active then were interrupted."""
        with self.lock:
            for r in runs:
                if r["status"] in ACTIVE:
                    r = r | {"status": "failed", "completed_at": now(), "failure": {"stage": None, "reason": "RUN_INTERRUPTED"}}
                self.runs[r["run_id"]] = r
                self.keys[r["key"]] = r["run_id"]

    def prune(self) -> None:
        """Forgets ended runs beyond the newest `keep`."""
        with self.lock:
            ended = sorted((r for r in self.runs.values() if r["status"] not in ACTIVE), key=lambda r: (r["completed_at"] or r["updated_at"], r["run_id"]), reverse=True)
            for r in ended[self.keep :]:
                self.runs.pop(r["run_id"])
                self.keys.pop(r["key"], None)
                self.futures.pop(r["run_id"], None)
                self.tokens.pop(r["run_id"], None)

    @staticmethod
    def public(run: dict) -> dict:
        """What a caller sees: no fingerprints, keys or paths."""
        return {k: run[k] for k in ("run_id", "status", "created_at", "updated_at", "completed_at", "failure", "progress_ratio")}


class Submissions:
    """Stage tasks submitted once: the same key and task give the same handle; the same key with another task, or an attempt
    submitted twice under other keys, is a conflict."""

    def __init__(self, start: Callable[[object], Future]):
        self.start, self.lock = start, threading.Lock()
        self.by_key: dict[str, tuple[object, tuple[str, int], Future]] = {}

    def submit(self, key: str, task: object, stage_run: str, attempt: int = 1) -> Future:
        with self.lock:
            if key in self.by_key:
                known, _, handle = self.by_key[key]
                if known != task:
                    raise ConflictError("the key belongs to another task")
                return handle
            if any(a == (stage_run, attempt) for _, a, _ in self.by_key.values()):
                raise ConflictError("the attempt was submitted before")
            handle = self.start(task)
            self.by_key[key] = (task, (stage_run, attempt), handle)
            return handle


def newest_terminal(runs: DataFrame, keep: int) -> DataFrame:
    """Active runs, and the newest `keep` of those that ended, by time and id. The same rule as a table operation."""
    ended = ~F.col("status").isin(*ACTIVE)
    # a top-N is taken by each task before it meets the others, so no task sorts all ended runs
    newest = runs.where(ended).orderBy(F.coalesce("completed_at", "updated_at").desc(), F.col("run_id").desc()).limit(keep)
    return runs.where(~ended).unionByName(newest)
