"""Full-text indexing, ranking, link analysis and relevance evaluation as Spark jobs."""

__version__ = "0.1.0"
