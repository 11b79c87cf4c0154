"""The registered queries of the subpackage."""

from rivulet.llm import q_chat, q_forest, q_hardneg, q_jaccard, q_langid, q_leaks, q_periodic, q_pieces, q_pitman_yor, q_secrets, q_tokencounts, q_toxicity, q_warc  # noqa: F401
from rivulet.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
