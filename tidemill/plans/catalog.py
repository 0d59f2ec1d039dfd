"""All registered queries."""

from tidemill.plans import (  # noqa: F401
    catalog_commerce,
    catalog_cross,
    catalog_functions,
    catalog_macro,
    catalog_market,
    catalog_platform,
)
from tidemill.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
