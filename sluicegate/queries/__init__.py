"""One query per operator over the given tables, each with its SQL counterpart."""

from sluicegate.queries import (
    checks,
    cleanups,
    conditions,
    extracts,
    layout,
    publishing,
    reports,
    schemas,
)
from sluicegate.queries.base import REGISTRY

__all__ = ["REGISTRY", "checks", "cleanups", "conditions", "extracts", "layout", "publishing", "reports", "schemas"]
