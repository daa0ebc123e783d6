"""DataFrame operators: ordinals, embedding, nearest neighbours, lookups, sampling, categories."""
