"""All queries of the subpackage (importing the modules registers them)."""

from . import q_dedup, q_models, q_scans, q_search  # noqa: F401
from .tables import ORACLES, QUERIES  # noqa: F401
