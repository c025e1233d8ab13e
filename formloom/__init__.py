"""formloom: Spark-native analytics over recognised form text and document corpora."""
