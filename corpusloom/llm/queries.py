"""The registered queries of this subpackage (importing registers them)."""

from corpusloom.llm import q_leaks, q_manifest, q_near, q_pages, q_quality, q_tokens, q_vectors  # noqa: F401
from corpusloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
