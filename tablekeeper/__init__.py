"""tablekeeper: DataFrame operators to keep, move and account for tables and text corpora.

* ``sources``   - reading corpora, writing and rewriting plain Parquet tables
* ``functions`` - Column functions: text profiling, rewriting, labels, T-SQL semantics
* ``operators`` - DataFrame operators: history, merge, sampling, routing, checking, reports
* ``plans``     - whole runs put together from the operators
"""
