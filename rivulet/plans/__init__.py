"""All registered queries; importing this package fills the registry."""

from rivulet.plans import cleaning, evaluation, learning, publishing, scalars, signals, summaries, texts  # noqa: F401
from rivulet.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
