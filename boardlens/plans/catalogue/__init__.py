"""Every operator on the shared test tables, with an equivalent SQL text where one exists."""

from boardlens.plans.catalogue import groups, joins, models, rows, wide  # noqa: F401
from boardlens.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
