"""Column expressions shared by the operators; all of them built from Spark built-ins."""
