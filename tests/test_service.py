import json
from concurrent.futures import Future

import pytest
from pyspark.sql import functions as F

from mediaweave import service
from mediaweave.functions import text
from mediaweave.plans.errors import ConflictError, ContractError, NotFoundError
from mediaweave.plans.runs import Submissions
from mediaweave.service import EvaluationCase, SearchRequest, SearchService

CARD = "media_id int, scene_id int, start_sec double, end_sec double, caption string, ocr_text string, chapter struct<title:string>, subtitle_text string, audio_event_text string, audio_events array<struct<label:string,confidence:double>>, transcript array<struct<start_sec:double,end_sec:double,speaker:string,text:string>>"
WORDS = ["red fox", "blue sky", "green hill", "old mill", "deep sea"]


def embed(texts):
    """Texts of the same words lie together."""
    return [[1.0 if w.split()[0] in t.lower() else 0.0 for w in WORDS] + [0.01] for t in texts]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [(m, s + 1, 10.0 * s, 10.0 * s + 10, f"{WORDS[(m + s) % 5]} here", None, None, None, None, [], [(10.0 * s, 10.0 * s + 1, None, "some words")]) for m in (1, 2) for s in range(5)]
    path = str(tmp_path_factory.mktemp("index"))
    service.build(spark, path, spark.createDataFrame(rows, CARD), embed)
    return path


def test_bounds_of_requests():
    ok = {"schema_version": "1", "query": " fox "}
    assert SearchRequest.parse(ok) == SearchRequest("fox") and SearchRequest.parse(ok | {"min_similarity": 1}).min_similarity == 1.0
    bad = [{}, {"query": "x"}, ok | {"more": 1}, ok | {"query": "  "}, ok | {"query": "?!"}, ok | {"query": "x" * 4001}, ok | {"top_k": 0}, ok | {"top_k": 101}, ok | {"top_k": True}, ok | {"top_k": 2.0}, ok | {"min_similarity": 1.1}, ok | {"max_context_tokens": 127}, ok | {"adjacent_scenes": 6}, [], None]
    for data in bad:
        with pytest.raises(ContractError):
            SearchRequest.parse(data)


def test_search_over_a_stored_index(spark, index):
    s = SearchService(spark, index, embed)
    matches, contexts = s.search([SearchRequest("red fox", 1, 0.35, 256, 1), SearchRequest("\uff22lue sky", 2, 0.35, 256, 0), SearchRequest("zebra", 3)])
    found = {(r.query_id, r["rank"]): (r.media_id, r.scene_id, list(r.reasons)) for r in matches.collect()}
    assert set(found) == {(0, 1), (1, 1), (1, 2)}
    assert found[0, 1][:2] in ((1, 5), (2, 4)) and found[0, 1][2] == ["keyword", "semantic"]
    assert {found[1, k][:2] for k in (1, 2)} == {(1, 1), (2, 5)}
    texts = {r.query_id: r for r in contexts.collect()}
    assert "red fox here" in texts[0].context and texts[0].token_count <= 256 and len(texts[0].included) in (2, 3)
    assert "zebra" not in texts[2].context and texts[2].included == []
    with pytest.raises(NotFoundError):
        SearchService(spark, index + "/none")


def test_evaluation(spark, index, tmp_path):
    s = SearchService(spark, index, embed)
    cases = [EvaluationCase("a", "blue sky", (1,)), EvaluationCase("b", "zebra", (), True), EvaluationCase("c", "deep sea", (4,))]
    r = s.evaluate(cases, 1, top_k=2).first()
    assert (r.case_count, r.recall_at_k, r.no_answer_precision, r.no_answer_recall) == (3, 1.0, 1.0, 1.0)
    data = {"schema_version": "1", "cases": [{"case_id": f"c{k}", "query": "q", "relevant_scene_ids": [1]} for k in range(30)]}
    file = tmp_path / "cases.json"
    file.write_text(json.dumps(data))
    assert len(service.load_cases(file)) == 30
    for broken in (data | {"cases": data["cases"][:29]}, data | {"cases": [data["cases"][0]] * 30}, data | {"x": 1}, data | {"cases": [*data["cases"], {"case_id": "z", "query": "q"}]}, data | {"cases": [*data["cases"], {"case_id": "z", "query": "q", "relevant_scene_ids": [1, 1]}]}):
        file.write_text(json.dumps(broken))
        with pytest.raises(ContractError):
            service.load_cases(file)


def test_submissions():
    s = Submissions(lambda task: Future())
    one = s.submit("k", {"stage": "a"}, "r")
    assert s.submit("k", {"stage": "a"}, "r") is one and s.submit("k2", {"stage": "a"}, "r", 2) is not one
    for key, task in (("k", {"stage": "b"}), ("k3", {"stage": "a"})):
        with pytest.raises(ConflictError):
            s.submit(key, task, "r")


def test_times_need_their_offset(spark):
    df = spark.createDataFrame([("2024-01-01T02:00:00Z",), ("2024-01-01T04:00:00.5+02:00",), (None,)], "t string")
    assert [r[0] for r in df.select(F.unix_micros(text.instant(F.col("t")))).collect()] == [1704074400000000, 1704074400500000, None]
    for bad in ("2024-01-01T02:00:00", "yesterday", "2024-01-01"):
        with pytest.raises(Exception, match="offset from UTC"):
            spark.createDataFrame([(bad,)], "t string").select(text.instant(F.col("t"))).collect()
