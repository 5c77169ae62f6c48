"""citylake: open-city-data analytics written as Spark DataFrame functions."""
