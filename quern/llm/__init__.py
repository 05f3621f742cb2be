"""Operators that prepare documents as training data for language models."""
