"""DataFrame -> DataFrame operators: cleaning, quality checks, analytics."""
