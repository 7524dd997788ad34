"""Archives, their members, text lines and traces as DataFrames."""
