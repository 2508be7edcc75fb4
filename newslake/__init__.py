"""newslake: a PySpark-native engine for news articles.

Raw articles (JSON envelopes, HTML pages or an event stream) become a medallion
lake, keyed warehouse tables and chart queries. Every job takes and returns
DataFrames; scalar logic is built from Column expressions.
"""
