"""All registered queries. Importing the package fills the registry."""

from . import evidence, layout, linkage, measures, pages, scalars  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
