"""strandwork: a PySpark engine for sequence catalogues and reference vocabularies."""
