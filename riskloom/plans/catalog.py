"""All registered queries, in the order of the inventory."""

from __future__ import annotations

from riskloom.plans import catalog_tables  # noqa: F401
from riskloom.plans import catalog_features  # noqa: F401
from riskloom.plans import catalog_scoring  # noqa: F401
from riskloom.plans import catalog_validation  # noqa: F401
from riskloom.plans import catalog_metrics  # noqa: F401
from riskloom.plans import catalog_models  # noqa: F401
from riskloom.plans import catalog_reports  # noqa: F401
from riskloom.plans import catalog_rollup  # noqa: F401
from riskloom.plans import catalog_star  # noqa: F401
from riskloom.plans import catalog_monitoring  # noqa: F401
from riskloom.plans import catalog_streams  # noqa: F401
from riskloom.plans.registry import ENTRIES

__all__ = ["ENTRIES"]
