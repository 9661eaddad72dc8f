"""Time-series features, forecasting and forecast evaluation as Spark jobs."""

__version__ = "0.1.0"
