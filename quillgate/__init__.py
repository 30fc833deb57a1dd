"""Spark-native building and quality gating of instruction datasets.

Every operator takes and returns DataFrames or Columns; nothing here holds
data in the driver.  See README.md for the map of modules.
"""

__version__ = "0.1.0"
