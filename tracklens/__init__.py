"""Spark-native analytics for frame-indexed multi-camera tracks and training-data pipelines."""
