"""riskweave: user-level risk analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing per-row
travels through the driver.  See README.md for the operator map.
"""

__version__ = "0.1.0"
