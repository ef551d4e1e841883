"""Column roles and the fixed values every operator shares."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values (they decide results and therefore stay literal).
SEED = 42
Z_95 = 1.959963984540054
ALPHA = 0.05
AGE_OFFSET = 1.0
MANY_EVENTS_FROM = 3
USAGE_UNIT = 10_000.0
AGE_DOMAIN = (0, 30)
USAGE_DOMAIN = (0, 500_000)
EVENTS_DOMAIN = (0, 100)
YEARLY_USAGE_RANGE = (2_000, 60_000)
TUKEY_FACTOR = 1.5
COST_RATIOS = (1.0, 2.0, 3.0, 5.0, 10.0, 20.0, 50.0)
ANCHOR_RATIO = 3.0
FALSE_POSITIVE_COST = 1.0
THRESHOLD_GRID = (0.01, 0.99, 197)
N_FOLDS = 5
N_REPETITIONS = 5
SELECTION_METRIC = "roc_auc"
MIN_CELL_SIZE = 20
MIN_LEVEL_SIZE = 10
CALIBRATION_BINS = 10
GAIN_SLICES = 10
N_PERMUTATIONS = 5
DEPENDENCE_POINTS = 30
HISTOGRAM_BINS = 22
DEGENERATE_SHARE = 0.85

# Right-closed band limits and their labels, in ascending order.
AGE_BANDS = (
    (1, "0-1 anos (novo)"),
    (3, "2-3 anos (garantia)"),
    (5, "4-5 anos (pos-garantia)"),
    (30, "6+ anos (maduro)"),
)
USAGE_BANDS = (
    (25_000, "ate 25 mil km"),
    (75_000, "25-75 mil km"),
    (125_000, "75-125 mil km"),
    (500_000, "acima de 125 mil km"),
)
BAND_FLOOR = -0.1


@dataclass(frozen=True)
class Roles:
    """Names of the input columns, plus the two label texts and the group domain."""

    unit_id: str = "unit_id"
    group: str = "grp"
    age: str = "age"
    usage: str = "usage_km"
    events: str = "events"
    label: str = "label"
    positive_text: str = "Sim"
    negative_text: str = "Não"
    groups: tuple[str, ...] = ()

    @property
    def numerics(self) -> tuple[str, str, str]:
        return (self.age, self.usage, self.events)

    @property
    def canonical(self) -> tuple[str, ...]:
        return (self.group, self.age, self.usage, self.events, self.label)


DEFAULT_ROLES = Roles()

# Derived columns, in the order they are added.
YEARLY_USAGE = "usage_per_year"
YEARLY_EVENTS = "events_per_year"
EVENTS_PER_USAGE = "events_per_10k"
MANY_EVENTS = "many_events"
AGE_BAND = "age_band"
USAGE_BAND = "usage_band"
DERIVED_NUMERICS = (YEARLY_USAGE, YEARLY_EVENTS, EVENTS_PER_USAGE)
