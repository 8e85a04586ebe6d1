"""Settings report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from snapdelta.operators.timeline import change_points, first_seen
from snapdelta.schema import SCOPE

COLUMNS = ("name", "setting", "context", "category", "short_desc")


def settings_current(settings: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """Every setting with each value it had, by category and name."""
    kept = [c for c in COLUMNS if c in settings.columns]
    return settings.select(*scope, *kept).distinct().orderBy(*scope, "category", "name")


def settings_first_seen(settings: DataFrame, scope: Sequence[str] = SCOPE) -> DataFrame:
    """First time of each value of the settings that changed."""
    return first_seen(settings, "setting", [*scope, "name"]).orderBy(*scope, "name", "change_time")


def settings_change_points(settings: DataFrame, scope: Sequence[str] = SCOPE, **options) -> DataFrame:
    """Every change of a setting, returns to an earlier value included."""
    return change_points(settings, ["setting"], [*scope, "name"], **options)
