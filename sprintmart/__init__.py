"""Sprint and customer data mart operators for PySpark."""
