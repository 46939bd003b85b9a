"""Claims-quality and feature engineering as Spark DataFrame operators."""
