"""Sales lakehouse analytics as plain DataFrame functions on Spark."""
