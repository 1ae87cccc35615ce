"""ledgerloom: a Spark-native analytics engine for project-based businesses."""
