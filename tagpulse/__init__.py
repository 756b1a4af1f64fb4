"""Hashtag analytics over social-media posts, as PySpark DataFrame operators."""
