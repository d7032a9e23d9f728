"""Property-market analytics as Spark DataFrame and Column operators."""
