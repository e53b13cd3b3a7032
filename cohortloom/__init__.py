"""Clinical cohort analytics as plain functions over Spark DataFrames."""
