"""sparkloom: data preparation, privacy, clustering and tour jobs on Spark.

Every operator is a function from DataFrame to DataFrame.  Spark partitions and
shuffles the work; the driver only ever sees results of a fixed, small size
(quantile edges, a p x p linear system, one row per column).
"""
