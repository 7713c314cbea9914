"""Bronze, silver and gold tables for sales files and hourly weather, on Spark."""
