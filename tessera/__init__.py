"""tessera: a Spark-first engine for document corpora and the tables around them."""
