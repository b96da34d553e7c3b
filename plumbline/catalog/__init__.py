"""Every operator bound to the test tables, with the SQL it must agree with."""

from plumbline.catalog import cleaning, drift, jobs, modelling, profiling, storage  # noqa: F401
from plumbline.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
