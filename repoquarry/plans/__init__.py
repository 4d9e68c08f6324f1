"""The four stages end to end: mining, integration, tokenization, embeddings."""
