"""Registered queries: each reads the driver's tables and runs one operator."""

from mentions.plans.registry import REGISTRY, Registered, register  # noqa: F401


def load_all() -> dict:
    """Import every query module so that its queries register themselves."""
    from mentions.plans import concept_queries, corpus_queries, entity_queries, flatten_queries, holder_queries, stream_queries  # noqa: F401,E501

    return REGISTRY
