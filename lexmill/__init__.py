"""Legal-corpus analytics on PySpark: catalog, parsing, graph, retrieval and quality plans as DataFrames."""
