"""qualstar — record-quality checks and star-schema analytics as Spark jobs."""

__version__ = "0.1.0"
