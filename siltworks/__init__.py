"""Training-data curation analytics as composable Spark DataFrame operators."""
