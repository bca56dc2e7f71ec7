"""chunkloom: a Spark-native engine that turns a source-code corpus into a retrieval dataset and scores it."""

__version__ = "0.1.0"
