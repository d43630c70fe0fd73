"""Section location over paged documents, and training-data operators (llm)."""
