"""Schema migration and data reconciliation on Spark."""
