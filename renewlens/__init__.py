"""Revenue and retention analytics for subscription businesses, as Spark jobs."""

__version__ = "0.1.0"
