"""Point-in-time analytics over revised time series, as DataFrame and SQL plans on Spark."""
