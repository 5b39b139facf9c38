"""tidewire: a Spark-native engine for a news knowledge-graph feed.

Raw tab-separated feed files become typed records, embedded texts and a
searchable vector table.  Every operator takes and returns DataFrames.
"""
