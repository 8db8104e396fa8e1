"""Reading and writing: text sources, the raw layer, the clean layer, published tables."""
