"""qaloom: a Spark-native engine that curates question/answer tables."""

__version__ = "0.1.0"
