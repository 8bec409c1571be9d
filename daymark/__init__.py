"""Daily batch lakehouse toolkit and reports, written as plain Spark DataFrame plans."""
