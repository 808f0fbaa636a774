"""loomtext: a Spark-native engine that turns wiki markup into plain text."""
