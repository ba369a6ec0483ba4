"""Reading and writing: schemas, CSV/JSON/Parquet, and the record views used by the queries."""
