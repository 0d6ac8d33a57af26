"""pagelathe: Spark-native analytics over scraped web pages.

Every operator takes DataFrames and returns a DataFrame; nothing here
collects data to the driver unless its docstring names the bound.
"""
