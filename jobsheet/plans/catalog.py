"""Importing this module registers every named query."""

from jobsheet.plans import (  # noqa: F401
    q_eval, q_lifecycle, q_models, q_monitor, q_orders, q_profile, q_sources, q_stream, q_text)
from jobsheet.plans.registry import REGISTRY  # noqa: F401
