"""Training-data operators over text, token and vector tables."""
