"""answerloom: evaluation of sampled model answers as Spark DataFrame work.

``functions``  Column -> Column building blocks (extraction, normalisation, ...)
``operators``  DataFrame -> DataFrame steps (grading, metrics, sharding, ...)
``sources``    readers, writers and their explicit schemas
``plans``      whole jobs composed from the above
``streaming``  the same merge and accuracy jobs fed by arriving run files
"""
