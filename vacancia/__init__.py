"""Job-market analytics as Spark DataFrame operators.

``functions``  column expressions (cleaning, banding, ratios)
``operators``  DataFrame in, DataFrame out
``sources``    schemas, readers, writers, fitted-model storage
``plans``      the operators composed into masters, stars and registered queries
"""
