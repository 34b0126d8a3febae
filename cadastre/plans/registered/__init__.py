"""Registered queries by family; importing this package registers all of them."""

from cadastre.plans.registered import cleaning, loading, models, profiling, quality  # noqa: F401
from cadastre.plans.registered.base import QUERIES, SQL  # noqa: F401
