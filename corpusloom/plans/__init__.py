"""All queries and their checking SQL."""

from corpusloom.plans import cleaning, encoding, hmm, markov, metrics, subwords  # noqa: F401
from corpusloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
