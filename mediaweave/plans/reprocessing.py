"""Query-guided reprocessing: which scenes a query points at, and what must run again for them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .cache import fingerprint
from .errors import ContractError, PlanError
from .stages import DERIVED_STAGES, Planner, StageRegistry


@dataclass(frozen=True)
class Profile:
    name: str
    stages: tuple[str, ...]
    settings: dict = field(default_factory=dict)


#: The profiles.
PROFILES = {"visual-detail-v1": Profile("visual-detail-v1", ("03_keyframes", "08_captions", "08_ocr", "09_timeline", "10_index", "11_context"), {"max_keyframes_per_scene": 3})}
#: Stages that work on the selected scenes alone; later ones make everything again.
SELECTED = ("03_keyframes", "08_captions", "08_ocr")


@dataclass(frozen=True)
class Submission:
    source_run_id: str
    query: str
    profile: str = "visual-detail-v1"
    max_scenes: int = 3
    min_similarity: float = 0.35

    def __post_init__(self):
        if not self.source_run_id.strip() or not self.query.strip() or len(self.query) > 4000:
            raise ContractError("a run and a query of at most 4000 characters are needed")
        if isinstance(self.max_scenes, bool) or not 1 <= self.max_scenes <= 100 or not -1 <= self.min_similarity <= 1:
            raise ContractError("the number of scenes or the similarity is out of bounds")


def candidates(matches: DataFrame, most: int) -> DataFrame:
    """The first `most` distinct scenes by rank. matches: query_id, media_id, scene_id, rank."""
    first = matches.groupBy("query_id", "media_id", "scene_id").agg(F.min("rank").alias("rank"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("rank", "media_id", "scene_id"))).where(F.col("place") <= most)


def plan(submission: Submission, scenes: list[int], source_prints: dict[str, str]) -> dict:
    """The plan with its fingerprint: the same submission over the same sources has the same one."""
    if submission.profile not in PROFILES:
        raise PlanError(f"no profile is named {submission.profile}")
    profile = PROFILES[submission.profile]
    order = Planner(StageRegistry(DERIVED_STAGES)).plan(start=profile.stages[0]).stages
    if order != profile.stages:
        raise PlanError("the profile's stages are not those of the plan")
    if not scenes:
        raise ContractError("the query points at no scene")
    body = {"submission": vars(submission), "stages": list(order), "scene_ids": list(dict.fromkeys(scenes)), "settings": profile.settings, "sources": source_prints}
    scope = {s: "selected-scenes" if s in SELECTED else "full-materialization" for s in order}
    return body | {"scope": scope, "fingerprint": fingerprint(body)}
