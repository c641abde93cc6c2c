"""marginalia: labelled-text analytics as composable Spark DataFrame operators."""
