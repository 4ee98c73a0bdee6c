"""Task descriptions: what a task's records look like and how it is prepared."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TaskSpec:
    """One task: `labels` for classification, `tag_map` for sequence tagging."""

    name: str
    labels: tuple[str, ...] = ()
    tag_map: dict[str, int] = field(default_factory=dict)
    expected_keys: tuple[str, ...] = ("text", "label")

    @property
    def is_tagging(self) -> bool:
        return bool(self.tag_map)


@dataclass(frozen=True)
class JobSpec:
    """The tasks of one family and the settings they share."""

    tasks: tuple[TaskSpec, ...]
    target_records: int
    records_per_request: int
    near_dup_threshold: float
    num_perm: int = 128
    test_share: float = 0.2
    seed: int = 42
    batch_size: int = 32
    diversity_sample: int = 200

    @property
    def is_tagging(self) -> bool:
        """The family is decided by its first task."""
        return self.tasks[0].is_tagging


# Task names, label sets, tag ids and sizes of the two families.
QUESTION = TaskSpec("is_question", labels=("Question", "Statement"))
CONFIRMATION = TaskSpec("confirmation", labels=("Affirm", "Deny"))
ENTITIES = TaskSpec(
    "ner_core_entity",
    tag_map={
        "O": 0,
        "B-PROJ": 1,
        "I-PROJ": 2,
        "B-PERS": 3,
        "I-PERS": 4,
        "B-EVT": 5,
        "I-EVT": 6,
    },
    expected_keys=("tokens", "tags"),
)

CLASSIFICATION = JobSpec(
    tasks=(QUESTION, CONFIRMATION),
    target_records=500,
    records_per_request=25,
    near_dup_threshold=0.85,
)
TAGGING = JobSpec(
    tasks=(ENTITIES,),
    target_records=5000,
    records_per_request=20,
    near_dup_threshold=0.95,
)

# Widths of the two feature blocks and the classifier's inverse penalty.
MAX_FEATURES = {"word": 5_000, "char": 10_000}
INVERSE_PENALTY = 20.0
