"""spendline: procurement analytics as composable Spark DataFrame operators."""
