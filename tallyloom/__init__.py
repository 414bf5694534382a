"""Dataframe, array, text and table analytics written as Spark jobs."""
