"""Composite jobs and the registry of named queries over the driver tables."""


def load_all():
    """Import every query module so that its queries register themselves."""
    from recspark.plans import (q_extra, q_features, q_metrics, q_recall, q_scalars, q_streaming,  # noqa: F401
                                q_swing, q_vectors)
    from recspark.plans.catalog import REGISTRY
    return REGISTRY
