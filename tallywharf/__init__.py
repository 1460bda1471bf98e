"""Shop activity and sales analytics as plain Spark DataFrame transformations."""
