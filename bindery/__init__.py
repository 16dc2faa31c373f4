"""bindery: Spark DataFrame operators for digital-book ingest, audit and corpus work."""
