"""strata: table and stream operators on Spark DataFrames.

``operators``  ordered scans, sorting, vectors, ledger, leases, text lines, score tables
``sources``    driver tables, fixed-length record files, whole texts as records
``functions``  shared column expressions
``plans``      the registered queries over the driver tables and their oracle SQL
``streaming``  stream twins (counter, balances, leases)
"""
