"""Weather analytics on PySpark: generate, train, verify."""
