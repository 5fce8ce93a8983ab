"""skeinworks: analytics operators for text, vectors, rankings and time series on Spark."""
