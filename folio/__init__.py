"""folio: document-corpus and library analytics on PySpark."""
