"""loomspan: interval, sequence and table analytics on PySpark."""
