"""Customer inactivity-risk analytics as Spark DataFrame operations."""
