"""readtrack: Spark-native analytics over chat exports and reading progress."""
