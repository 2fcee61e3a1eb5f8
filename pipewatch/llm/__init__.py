"""Training-data operators: search, deduplication, counting, filtering,
archiving, scoring, mixing, packing and sharding of a text corpus.

Each module holds one operator with a general interface over DataFrames;
``queries`` registers the thin ``opN_<name>`` queries over the driver
tables.  Nothing outside this subpackage (and ``corpus_pipeline.py``)
imports it.
"""
