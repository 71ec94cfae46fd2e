"""Catalume: catalog analytics on Spark, as DataFrame and Column functions."""
