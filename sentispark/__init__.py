"""Sentiment analytics on short posts, written as Spark DataFrame jobs."""
