"""Property-ownership and price analytics as plain Spark DataFrame functions."""
