"""Conversation analytics as composable PySpark DataFrame transformations."""
