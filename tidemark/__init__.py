"""Survey statistics, rating prediction, frequent itemsets, text clustering and
stream sampling as PySpark DataFrame operators."""
