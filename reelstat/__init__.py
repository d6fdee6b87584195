"""reelstat — ratings analytics and factor-model jobs on Spark DataFrames."""

__version__ = "0.1.0"
