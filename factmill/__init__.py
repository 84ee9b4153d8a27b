"""factmill: document collections to versioned, queryable facts on Spark."""
