"""The same results in plain SQL, for checking the Spark operators."""
