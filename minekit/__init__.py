"""minekit: config-driven, table-in / table-out data-mining operators on Spark.

Subpackages
-----------
functions   column expressions: strict casts, text splitting, spec decoding
sources     reading and writing tables (parquet, JDBC, text)
operators   the mining operators (naive Bayes, tree, k-means, SGD regression,
            ALS, FP-growth) as DataFrame -> DataFrame functions
plans       job specs and the composite spec-driven jobs, plus the catalogue
            of registered queries over the test tables
streaming   intentionally empty (the reference has no streaming code)
"""

__version__ = "0.1.0"
