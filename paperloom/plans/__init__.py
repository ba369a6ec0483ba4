"""The query catalogue: every operator run over the supplied tables, with its SQL equivalent."""

from . import enrichment, evaluation, features, modelling, profiling, records, textual  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
