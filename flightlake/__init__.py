"""flightlake: flight-operations analytics as plain Spark DataFrame functions."""
