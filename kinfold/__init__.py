"""kinfold: Spark-native business entity resolution and corpus preparation."""
