"""Shop-data analytics on Spark: clicks, views, orders, catalogues, text and reviews."""
