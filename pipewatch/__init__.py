"""pipewatch: pipeline-audit operators on Spark DataFrames.

Every operator is a function from DataFrames (plus plain arguments) to a
DataFrame.  Sub-packages:

* ``functions`` - column expressions (name folding, JSON maps, local time)
* ``plans``     - reusable plan shapes (the skew-safe running max) and the
                  registry of audit queries used by ``__spark_entry__``
* ``operators`` - the audits: topics, replication stats, catalogue, history,
                  loads, schema conformance, key-value items, SQL entry
* ``sources``   - readers and the logical inputs derived from driver tables
* ``streaming`` - Structured Streaming forms (landing, per-key lateness)
"""

__version__ = "0.1.0"
