"""All catalogue queries (importing the modules registers them)."""

from panelcast.plans import (q_calendar, q_decisions, q_drift, q_eval, q_features, q_io, q_misc, q_ml,  # noqa: F401
                             q_serving, q_state, q_stream)
from panelcast.plans.q_features import flagship  # noqa: F401
from panelcast.plans.registry import ORACLES, QUERIES  # noqa: F401

# Twins whose output equals a batch result reuse that result's SQL oracle.
q_io._register_file_oracles()
q_stream._register_twin_oracles()
