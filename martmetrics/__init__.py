"""martmetrics — retail report operators (daily, period-to-date and month-end metrics)
as Spark DataFrame plans."""

__version__ = "0.1.0"
