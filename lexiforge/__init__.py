"""A Spark-native engine that curates and audits question-answer training data."""
