"""Shop-event analytics on Spark: cleaning, features, forecasts, scoring."""
