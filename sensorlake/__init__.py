"""sensorlake: sensor stream analytics on PySpark.

Decode and check device readings and window open/close events, flag
anomalies, aggregate them in tumbling event-time windows (batch and stream),
pair openings with closings, and serve "as of" queries -- all as DataFrame,
SQL and Structured Streaming plans. See README.md for the layout.
"""

__version__ = "0.1.0"
