"""Order-experience analytics as composable PySpark DataFrame functions."""
