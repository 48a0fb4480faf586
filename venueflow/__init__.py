"""Daily-demand feature, forecast, validation and ensemble operators on Spark DataFrames."""
