"""fraudspark: card-fraud features, scoring and monitoring as Spark jobs."""

__version__ = "0.1.0"
