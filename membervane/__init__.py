"""Member value and churn analytics as PySpark DataFrame-to-DataFrame operators."""
