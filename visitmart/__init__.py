"""Visit marts, CRM flattening and SQL-to-frame jobs, written as Spark DataFrame plans."""
