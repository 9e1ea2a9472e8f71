"""Text-to-knowledge-graph analytics on PySpark: every operator is a DataFrame transformation."""
