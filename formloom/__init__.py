"""Form-extraction analytics on PySpark: DataFrame in, DataFrame out."""
