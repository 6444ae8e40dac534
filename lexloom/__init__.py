"""lexloom: document processing and retrieval-index preparation on Spark DataFrames."""
