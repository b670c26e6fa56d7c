"""Entity-by-period panel analytics and scenario forecasting on Spark DataFrames."""
