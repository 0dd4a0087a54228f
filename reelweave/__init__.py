"""Media-catalogue and box-office analytics on PySpark DataFrames."""
