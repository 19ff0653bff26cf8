"""Record linkage and document processing over long-running proceedings, on Spark DataFrames."""
