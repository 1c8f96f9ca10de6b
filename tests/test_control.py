import pytest
from pyspark.sql import functions as F

from mediaweave.plans.cache import Artifact, CacheEvaluator, Manifest, Task, fingerprint, normal_json
from mediaweave.plans.engine import CancellationToken, Engine, RetryPolicy, RunResult, StageFailed, StateMachine, STAGE_STEPS
from mediaweave.plans.errors import CapacityError, ConflictError, ContractError, NotFoundError, PlanError
from mediaweave.plans.reprocessing import Submission, plan
from mediaweave.plans.runs import RunService
from mediaweave.plans.stages import DEFAULT_STAGES, Planner, StageRegistry, StageSpec
from mediaweave.sources.stores import FileStore, MediaCatalog, RunStore, TableStore, restore_bundle, write_bundle


def spec(name, after=(), inputs=(), outputs=()):
    return StageSpec(name, after=tuple(after), inputs=tuple(inputs), outputs=tuple(outputs))


def test_plans():
    p = Planner(StageRegistry(reversed(DEFAULT_STAGES)))
    assert p.order == tuple(s.name for s in DEFAULT_STAGES)
    part = p.plan(start="09_timeline")
    assert part.stages == ("09_timeline", "10_index", "11_context")
    assert "scenes" in part.boundary_inputs and "timeline" not in part.boundary_inputs
    assert p.plan(start="03_keyframes", end="08_ocr").stages == ("03_keyframes", "08_captions", "08_ocr")
    for bad in ([spec("a", ["b"]), spec("b", ["a"])], [spec("a", ["z"])], [spec("a"), spec("a")], [spec("a", outputs=["x"]), spec("b", outputs=["x"])], [spec("a", outputs=["x"]), spec("b", inputs=["x"])]):
        with pytest.raises(PlanError):
            Planner(StageRegistry(bad))


def test_cache_reasons():
    a = Artifact("i", "u", 1, "s")
    task = Task("st", "1", {"x": a}, {"k": 1}, {"m": "m"})
    done = Manifest(task, "succeeded", {"o": a}, (("m", "p"),), task.cache_key())
    ok = CacheEvaluator(lambda x: None)
    reasons = lambda *x, ev=ok, **k: [r for r, _ in ev.decide(*x, **k).misses]
    assert ok.decide(task, done, (("m", "p"),)).status == "hit"
    assert reasons(task, done, force=True) == ["FORCE_REQUESTED"]
    assert reasons(task, None) == ["MANIFEST_NOT_FOUND"]
    other = Task("st", "2", {"x": Artifact("i", "u", 2, "t")}, {"k": 2}, {"m": "m"}, "2")
    assert reasons(other, done, (("m", "p"),)) == ["TASK_SCHEMA_CHANGED", "STAGE_VERSION_CHANGED", "INPUTS_CHANGED", "CONFIG_CHANGED", "CACHE_KEY_MISMATCH"]
    assert reasons(task, Manifest(task, "skipped", {}, (("m", "p"),), None), (("m", "p"),)) == ["CACHE_KEY_MISSING", "SKIPPED_RECHECK_REQUIRED"]
    assert reasons(task, done) == ["EFFECTIVE_MODELS_UNAVAILABLE"]
    assert reasons(task, done, (("m", "q"),)) == ["EFFECTIVE_MODELS_CHANGED"]
    assert reasons(task, done, (("m", "p"),), ev=CacheEvaluator(lambda x: "CHECKSUM_MISMATCH")) == ["INPUT_CHECKSUM_MISMATCH", "OUTPUT_CHECKSUM_MISMATCH"]


def test_canonical_json():
    assert fingerprint({"b": 1, "a": [1.5, None]}) == fingerprint({"a": [1.5, None], "b": 1})
    for bad in (float("nan"), {1: 2}, {"x": object()}):
        with pytest.raises((ValueError, TypeError)):
            normal_json(bad)


def test_engine(spark, tmp_path):
    calls = {"b": 0}

    def flaky(tables, config):
        calls["b"] += 1
        if calls["b"] == 1:
            raise StageFailed("PROVIDER_UNAVAILABLE")
        return {"y": tables["x"].withColumn("z", F.lit(config.get("z", 1)))}

    registry = StageRegistry([spec("a", (), ["in"], ["x"]), spec("b", ["a"], ["x"], ["y"]), spec("c", ["b"], ["y"], ["w"])])
    functions = {"a": lambda t, c: {"x": t["in"]}, "b": flaky, "c": lambda t, c: {"bad": t["y"]}}
    store, runs = TableStore(spark, str(tmp_path)), RunStore()
    engine = Engine(spark, registry, functions, store, runs, RetryPolicy(3))
    data = store.write(spark.range(3))
    r = engine.run(engine.planner.plan(end="b"), {"in": data}, "r1")
    assert (r.status, r.stages["b"].attempts, r.progress) == ("succeeded", 2, 1.0)
    assert store.read(r.stages["b"].outputs["y"]).count() == 3
    again = engine.run(engine.planner.plan(), {"in": data}, "r2")
    assert [s.status for s in again.stages.values()] == ["cached", "cached", "failed"]
    assert again.stages["c"].reason == "UNDECLARED_OUTPUT"
    changed = engine.run(engine.planner.plan(end="b"), {"in": data}, "r3", {"b": {"z": 2}})
    assert [s.status for s in changed.stages.values()] == ["cached", "succeeded"]
    assert engine.preview(engine.planner.plan(), {"in": data}, {"b": {"z": 9}})["c"][0] == "blocked"
    assert engine.run(engine.planner.plan(stage="b"), {}, "r4").stages["b"].reason == "MISSING_REQUIRED_INPUT"
    stop = CancellationToken()
    stop.cancel()
    assert engine.run(engine.planner.plan(), {"in": data}, "r5", token=stop).status == "cancelled"
    runs.save(tmp_path / "journal.jsonl")
    assert RunStore.load(tmp_path / "journal.jsonl").by_key(changed.stages["b"].decision.cache_key).outputs == changed.stages["b"].outputs


def test_states():
    m = StateMachine(STAGE_STEPS)
    m.to("ready")
    with pytest.raises(ContractError):
        m.to("succeeded")
    assert RetryPolicy(2, 1.0, 2.0, 3.0).delay(3) == 3.0


def test_runs():
    s = RunService(lambda run_id, request, token: RunResult(run_id, "succeeded", {}), capacity=1, keep=1)
    run, new = s.create("k", {"v": 1})
    assert new and s.wait(run["run_id"], 10)["status"] == "succeeded"
    assert s.create("k", {"v": 1}) == (s.get(run["run_id"]), False)
    with pytest.raises(ConflictError):
        s.create("k", {"v": 2})
    s.restore([{"run_id": "old", "key": "o", "fingerprint": "", "status": "running", "created_at": "0", "updated_at": "0", "completed_at": None, "failure": None, "progress_ratio": 0.0}])
    assert s.get("old")["failure"]["reason"] == "RUN_INTERRUPTED"
    s.prune()
    with pytest.raises(NotFoundError):
        s.get(run["run_id"])
    s.capacity = 0
    with pytest.raises(CapacityError):
        s.create("z", {})


def test_files(tmp_path):
    store = FileStore(tmp_path / "s")
    a = store.publish(store.put(b"hello"), "d/x.bin")
    assert store.open(a).read() == b"hello" and store.verify(a) is None
    (tmp_path / "s" / "d" / "x.bin").write_bytes(b"hellO")
    assert store.verify(a) == "CHECKSUM_MISMATCH"
    for bad in ("../x", "/x", "a//b", ""):
        with pytest.raises(ContractError):
            store.register(bad)
    members = {"b.jpg": b"2", "a.jpg": b"1"}
    for name in ("one.zip", "two.zip"):
        write_bundle(tmp_path / name, members)
    assert (tmp_path / "one.zip").read_bytes() == (tmp_path / "two.zip").read_bytes()
    assert len(restore_bundle(tmp_path / "one.zip", tmp_path / "out", {"a.jpg", "b.jpg"})) == 2
    with pytest.raises(ContractError):
        restore_bundle(tmp_path / "one.zip", tmp_path / "out", {"a.jpg"})
    with pytest.raises(NotFoundError):
        MediaCatalog(tmp_path, {}).resolve("x")


def test_reprocessing():
    s = Submission("run", "query")
    p = plan(s, [3, 1, 3], {"scenes": "x"})
    assert p["scene_ids"] == [3, 1] and p == plan(s, [3, 1], {"scenes": "x"})
    assert p["scope"]["08_ocr"] == "selected-scenes" and p["scope"]["10_index"] == "full-materialization"
    with pytest.raises(ContractError):
        plan(s, [], {})
