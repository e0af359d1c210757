"""lakeworks: sales-lake, analytics and data-quality jobs written on PySpark."""
