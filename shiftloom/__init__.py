"""shiftloom: plant analytics (OEE, stoppages, sensors, snapshots) on Spark DataFrames."""

__version__ = "0.1.0"
