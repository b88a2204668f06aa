"""recspark - recommender-system data processing as Spark DataFrame jobs."""

__version__ = "0.1.0"
