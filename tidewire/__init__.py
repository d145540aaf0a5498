"""tidewire: news and document curation on Spark DataFrames."""
