"""Canonical column names ("roles") of a panel and the renaming to and from a user's names.

Every operator speaks in roles, so the same code serves any entity x period data set; a
``PanelSpec`` is a pure renaming and costs nothing once Catalyst has collapsed the projections.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame

ENTITY = "entity"
NAME = "name"
PERIOD = "period"
CATEGORY = "category"
CATEGORY_CODE = "category_code"
METRIC_A = "a"
METRIC_A_LOW = "a_low"
METRIC_A_HIGH = "a_high"
METRIC_B = "b"
METRIC_B2 = "b2"
GROUP = "grp"
GROUP_CODE = "grp_code"

KEY = [ENTITY, PERIOD]
OBSERVATION_KEY = [ENTITY, PERIOD, CATEGORY_CODE]


@dataclass(frozen=True)
class PanelSpec:
    """User column name for every role."""

    entity: str = ENTITY
    name: str = NAME
    period: str = PERIOD
    category: str = CATEGORY
    category_code: str = CATEGORY_CODE
    a: str = METRIC_A
    a_low: str = METRIC_A_LOW
    a_high: str = METRIC_A_HIGH
    b: str = METRIC_B
    b2: str = METRIC_B2
    grp: str = GROUP
    grp_code: str = GROUP_CODE

    def to_roles(self, df: DataFrame) -> DataFrame:
        present = {user: role for role, user in asdict(self).items() if user in df.columns}
        return df.withColumnsRenamed(present)

    def from_roles(self, df: DataFrame, derived: dict[str, str] | None = None) -> DataFrame:
        """Rename role columns back, plus any derived output columns."""
        names = {**asdict(self), **(derived or {})}
        return df.withColumnsRenamed({r: u for r, u in names.items() if r in df.columns})
