"""tidecast: demand series, features, forecasts and monitoring as Spark DataFrame jobs."""

__version__ = "0.1.0"
