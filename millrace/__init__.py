"""millrace: a PySpark-native analytics engine for batch queries and continuously maintained views."""
