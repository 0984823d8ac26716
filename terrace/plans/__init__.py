"""The warehouse models as functions over DataFrames."""
