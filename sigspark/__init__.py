"""sigspark — compound–gene signature analytics on Spark DataFrames.

Layout:
    sources/    readers, the test-data binding, landed tables, sinks
    operators/  reshape, join, quality and statistics operators
    functions/  column expressions (tiers, categories, labels, formats)
    plans/      the business questions, literature, temporal, profiles, jobs
    streaming/  incremental append with Structured Streaming

Every operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver inside an operator.
"""

from sigspark.errors import ValidationError

__all__ = ["ValidationError"]
