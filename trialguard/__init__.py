"""trialguard: clinical-trial safety analytics on Spark DataFrames.

Packages: ``functions`` (Column expressions), ``sources`` (readers),
``operators`` (cleaning, SDTM, ADaM, conformance, tables, views), ``plans``
(query catalogue, DuckDB oracle, end-to-end run), ``sinks`` (writers).
"""

__version__ = "0.1.0"
