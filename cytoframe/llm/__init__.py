"""Training-data operators: ten corpus operations on documents and embeddings."""
