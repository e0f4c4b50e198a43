"""Training-data operators: counting, mixing, filtering, joining and writing corpora.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries only when it is present.
"""
