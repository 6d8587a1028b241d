"""Record shapes and domain parameters of a long-format indicator panel.

A panel row says: *entity* (belonging to *group*) had *value* for *indicator*
in *year*, as known at *at*.  Every operator takes a :class:`PanelSpec`, so the
same code runs on tables whose columns carry other names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("federal_district", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("indicator", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("collected_at", T.TimestampType()),
    ]
)

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("federal_district", T.StringType()),
    ]
)


@dataclass(frozen=True)
class PanelSpec:
    """Column names of a panel.

    ``order`` lists the columns that reproduce input order; the last one should
    be unique.  ``scale`` is the number of decimals the values are known to
    have; when it is set, sums run in DECIMAL and no longer depend on the order
    in which partitions are merged.
    """

    entity: str = "region"
    group: str = "federal_district"
    year: str = "year"
    indicator: str = "indicator"
    value: str = "value"
    at: str = "collected_at"
    order: tuple[str, ...] = ("collected_at", "seq")
    scale: int | None = None

    @property
    def key(self) -> list[str]:
        """Natural key of a panel cell."""
        return [self.entity, self.indicator, self.year]

    @property
    def required(self) -> list[str]:
        return [self.entity, self.indicator, self.value, self.year]

    @property
    def columns(self) -> list[str]:
        return [self.entity, self.group, self.year, self.indicator, self.value, self.at]


@dataclass(frozen=True)
class Range:
    """Inclusive value range; ``shown`` is how error texts print it."""

    low: float
    high: float
    shown: str = ""

    @property
    def text(self) -> str:
        return self.shown or f"[{float(self.low)}, {float(self.high)}]"


@dataclass(frozen=True)
class RuleSet:
    """Everything a row is checked against."""

    indicators: tuple[str, ...]
    ranges: dict[str, Range] = field(default_factory=dict)
    year_range: tuple[int, int] = (1990, 2030)
    name_length: tuple[int, int] = (2, 100)


@dataclass(frozen=True)
class Step:
    """Constant shift of an indicator's expectation over an inclusive year span."""

    indicator: str
    first: int | None
    last: int | None
    shift: float


@dataclass(frozen=True)
class Slope:
    """Shift of ``per_year`` for every year after ``since`` (from ``first`` on)."""

    indicator: str
    since: int
    per_year: float
    first: int | None = None


@dataclass(frozen=True)
class Growth:
    """Relative trend: expectation is multiplied by ``1 + (year - since) * rate``."""

    indicator: str
    since: int
    rate: float


@dataclass(frozen=True)
class Baseline:
    """Expected value of a cell: mean and spread per indicator plus trend terms."""

    params: dict[str, tuple[float, float]]
    entity_means: dict[str, dict[str, float]] = field(default_factory=dict)
    growth: tuple[Growth, ...] = ()
    steps: tuple[Step, ...] = ()
    slopes: tuple[Slope, ...] = ()


@dataclass(frozen=True)
class FilterSpec:
    """Optional conjunctive filter; ``None``, ``""`` and ``0`` mean "not set"."""

    indicator: str | None = None
    year_from: int | None = None
    year_to: int | None = None
    region: str | None = None


# Indicator codes, labels, limits, expectations and clamps of the
# demographic panel.  They are data, not logic, and must stay as they are.
SERVICE_PREFIX = "_agg_"

DEMOGRAPHIC_INDICATORS = (
    "population",
    "birth_rate",
    "death_rate",
    "natural_growth",
    "migration_growth",
    "life_expectancy",
)

DEMOGRAPHIC_LABELS = {
    "population": "Население",
    "birth_rate": "Рождаемость (на 1000)",
    "death_rate": "Смертность (на 1000)",
    "natural_growth": "Естественный прирост (на 1000)",
    "migration_growth": "Миграционный прирост (на 1000)",
    "life_expectancy": "Ожидаемая продолжительность жизни",
}

DEMOGRAPHIC_RULES = RuleSet(
    indicators=DEMOGRAPHIC_INDICATORS,
    ranges={
        "population": Range(1_000.0, 20_000_000.0, "[1_000, 20_000_000]"),
        "birth_rate": Range(0.0, 100.0),
        "death_rate": Range(0.0, 100.0),
        "natural_growth": Range(-100.0, 100.0),
        "migration_growth": Range(-100.0, 100.0),
        "life_expectancy": Range(30.0, 100.0),
    },
    year_range=(1990, 2030),
    name_length=(2, 100),
)

DEMOGRAPHIC_BASELINE = Baseline(
    params={
        "population": (1_200_000.0, 800_000.0),
        "birth_rate": (11.5, 2.5),
        "death_rate": (13.0, 2.0),
        "natural_growth": (-1.5, 3.0),
        "migration_growth": (0.5, 2.0),
        "life_expectancy": (70.5, 3.5),
    },
    entity_means={
        "population": {
            "Москва": 12_500_000.0,
            "Санкт-Петербург": 5_400_000.0,
            "Московская область": 7_700_000.0,
            "Краснодарский край": 5_700_000.0,
            "Республика Башкортостан": 4_000_000.0,
            "Республика Татарстан": 3_900_000.0,
            "Свердловская область": 4_300_000.0,
            "Ростовская область": 4_200_000.0,
            "Нижегородская область": 3_200_000.0,
            "Челябинская область": 3_500_000.0,
        }
    },
    growth=(Growth("population", 2000, 0.003),),
    steps=(
        Step("birth_rate", 2006, 2015, 1.5),
        Step("birth_rate", 2016, None, -0.5),
        Step("death_rate", 2020, 2021, 3.0),
        Step("life_expectancy", 2020, 2021, -2.0),
    ),
    slopes=(
        Slope("death_rate", 2005, -0.08, first=2005),
        Slope("life_expectancy", 2000, 0.25),
    ),
)

DEMOGRAPHIC_BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "population": (10_000.0, None),
    "birth_rate": (2.0, 50.0),
    "death_rate": (2.0, 50.0),
    "life_expectancy": (40.0, 85.0),
}

DEMOGRAPHIC_YEARS = (2000, 2023)

ABSENT_LABEL = "—"

SKIPPED_NAMES = ("aggregated", "rejected", "_bench", "smoke")

MESSAGE_TOPIC = "demographics-raw"
