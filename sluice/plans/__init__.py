"""Registered queries, one module per family of operators."""

from sluice.plans import cleansing, documents, flagship, io, quality, validation  # noqa: F401
from sluice.plans.registry import PLANS, SQL, Tables  # noqa: F401
