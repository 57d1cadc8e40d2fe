"""Spark library that builds, scores and prepares question/answer text datasets."""
