"""mediamart: media and advertising event analytics on Spark.

Hourly event feeds are null-filled into hour-partitioned staging tables and
modelled into a star schema (date spine, location, movie, SCD2 user
dimensions, an as-of fact and a wide view). Everything is DataFrame / SQL /
Structured Streaming work; see README.md for the module map.
"""

__version__ = "0.1.0"
