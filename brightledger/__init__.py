"""Statement-graph analytics and table operators for Spark."""
