"""All queries of the core."""

from marketloom.plans import analytics, candidates, cascade, cleaning, dealt, relational, scoring
from marketloom.plans.registry import Registry


def core() -> Registry:
    registry = Registry()
    for family in (dealt, cleaning, candidates, cascade, scoring, analytics, relational):
        registry.merge(family.REGISTRY)
    return registry
