"""All queries of the engine, by name: importing the query modules registers them."""

from kilnspark.plans import answer_queries, corpus_queries, dialogue_queries, filter_queries, generate_queries, graph_queries, knowledge_queries, metric_queries, record_queries, sample_queries, source_queries, tool_queries  # noqa: F401
from kilnspark.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
