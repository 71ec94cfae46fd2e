"""All registered queries of the catalog part, and their oracles."""

from __future__ import annotations

from catalume.plans import queries, whole_queries
from catalume.plans.oracles import ORACLES as PLAIN
from catalume.plans.whole_oracles import WHOLE

QUERIES = queries.QUERIES | whole_queries.WHOLE
ORACLES = PLAIN | WHOLE
