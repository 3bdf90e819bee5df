"""Feature, scoring, campaign and monitoring operators: DataFrames in, a DataFrame out."""
