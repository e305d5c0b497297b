"""All registered queries."""

from millrace.plans import (  # noqa: F401  (importing registers)
    job_queries,
    learner_queries,
    profile_queries,
    sampling_queries,
    table_queries,
    training_queries,
)
from millrace.plans.registry import ORACLES, QUERIES  # noqa: F401
