"""Fare analytics as Spark DataFrame operations.

``functions``  column expressions (time, money, identity, text)
``sources``    schemas, registries, feed and table readers and writers
``operators``  DataFrame -> DataFrame building blocks
``plans``      the composite questions, and the demo views over the driver tables
``streaming``  the same operators on unbounded feeds
"""
