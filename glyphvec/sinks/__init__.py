"""Writers for embeddings, index parts, text tables, results and reports."""
