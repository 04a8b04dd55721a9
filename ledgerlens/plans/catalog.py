"""All registered queries; importing this module fills the registry."""

from ledgerlens.plans import (  # noqa: F401
    catalog_behaviour, catalog_model, catalog_profile, catalog_quality, catalog_rates, catalog_rules,
    catalog_io, catalog_streaming)
from ledgerlens.plans.registry import BENCH, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "BENCH"]
