"""kindred: entity resolution and training-data operators on PySpark DataFrames."""
