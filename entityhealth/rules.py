"""Rule tables: baselines, points, keywords and bands per category.

The tables are plain data. `entityhealth.operators.scoring` lowers them to
column expressions, `rule_table` to a small typed DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Alert levels from most to least severe, their codes and colours.
RED = "Đỏ (Nguy cơ cao)"
ORANGE = "Cam (Cảnh báo)"
YELLOW = "Vàng (Theo dõi)"
GREEN = "Xanh (Bình thường)"
LEVELS = (RED, ORANGE, YELLOW, GREEN)
LEVEL_CODES = {RED: 3, ORANGE: 2, YELLOW: 1, GREEN: 0}
LEVEL_COLOURS = {RED: "#DC3545", ORANGE: "#FD7E14", YELLOW: "#FFC107", GREEN: "#28A745"}
# A level text belongs to the class of the first word it contains.
LEVEL_CLASSES = (("Đỏ", "text-red"), ("Cam", "text-orange"), ("Vàng", "text-yellow"), ("Xanh", "text-green"))
PREDICTION_BANDS = ((2.5, "text-red"), (1.5, "text-orange"), (0.5, "text-yellow"))


@dataclass(frozen=True)
class Baseline:
    """Normal mean and spread of one metric in one category."""

    mean: float
    std: float

    def __post_init__(self) -> None:
        if self.std <= 0:
            raise ValueError("a baseline needs a positive std")


@dataclass(frozen=True)
class Metric:
    """A measured column; `name` prefixes the z-score and flag columns."""

    name: str
    column: str

    @property
    def zscore(self) -> str:
        return f"{self.name}_zscore"

    @property
    def flag(self) -> str:
        return f"is_{self.name}_anomaly"


@dataclass(frozen=True)
class NoteSignal:
    """A yes/no signal read from the note text."""

    name: str
    flag: str


@dataclass(frozen=True)
class CategoryRules:
    """All rules of one category; a metric without a baseline is not scored."""

    category: str
    baselines: Mapping[str, Baseline]
    points: Mapping[str, int]
    keywords: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    red: int = 5
    orange: int = 3
    yellow: int = 1


@dataclass(frozen=True)
class RuleSet:
    metrics: tuple[Metric, ...]
    signals: tuple[NoteSignal, ...]
    categories: tuple[CategoryRules, ...]
    z_limit: float = 2.0

    def __post_init__(self) -> None:
        if not self.categories:
            raise ValueError("a rule set needs at least one category")
        names = [c.category for c in self.categories]
        if len(set(names)) != len(names):
            raise ValueError("categories must be unique")

    @property
    def flags(self) -> list[str]:
        return [m.flag for m in self.metrics] + [s.flag for s in self.signals]


STRESS = NoteSignal("stress", "note_is_stressful")
ILLNESS = NoteSignal("illness", "note_is_illness_related")

# Baselines, points and keyword lists of the two species.
DEFAULT_RULES = RuleSet(
    metrics=(
        Metric("food", "food_amount"),
        Metric("sleep", "sleep_hours"),
        Metric("weight", "weight_kg"),
        Metric("meow", "meow_count"),
    ),
    signals=(STRESS, ILLNESS),
    categories=(
        CategoryRules(
            category="dog",
            baselines={"food": Baseline(250, 50), "sleep": Baseline(12, 2), "weight": Baseline(15, 5)},
            points={"food": 1, "sleep": 1, "weight": 2, "meow": 0, "stress": 2, "illness": 3},
            keywords={
                "stress": (
                    "sợ sấm", "phá phách", "sủa nhiều", "cắn phá", "run rẩy", "gầm gừ", "lo lắng", "bồn chồn",
                    "chán ăn",
                ),
                "illness": (
                    "ho khan", "nôn", "khập khiễng", "chảy nước mũi", "ghẻ", "bọ chét", "đau chân", "tiêu chảy",
                    "rụng lông",
                ),
            },
        ),
        CategoryRules(
            category="cat",
            baselines={
                "food": Baseline(180, 30),
                "sleep": Baseline(15, 3),
                "weight": Baseline(4, 1),
                "meow": Baseline(5, 3),
            },
            points={"food": 1, "sleep": 1, "weight": 2, "meow": 1, "stress": 2, "illness": 3},
            keywords={
                "stress": (
                    "lẩn trốn", "liếm lông quá mức", "cào cấu đồ đạc", "gầm gừ", "giấu mình",
                    "tiểu tiện không đúng chỗ", "lo lắng", "bồn chồn", "chán ăn",
                ),
                "illness": (
                    "nôn ra lông", "ho khan", "nhiễm trùng mắt", "nấm da", "rụng lông", "biếng ăn",
                    "chảy nước mắt", "đi tiểu ra máu", "tiêu chảy",
                ),
            },
        ),
    ),
)


def rule_table(spark: SparkSession, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """The rule set as an inline table: one row per category and signal or metric."""
    rows = []
    for c in rules.categories:
        for m in rules.metrics:
            b = c.baselines.get(m.name)
            limits = (float(b.mean), float(b.std)) if b else (None, None)
            rows.append((c.category, m.name, *limits, c.points.get(m.name, 0), None))
        for s in rules.signals:
            words = list(c.keywords.get(s.name, ()))
            rows.append((c.category, s.name, None, None, c.points.get(s.name, 0), words))
    schema = "category string, rule string, mean double, std double, points int, keywords array<string>"
    return spark.createDataFrame(rows, schema)
