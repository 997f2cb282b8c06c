"""Spark-native toolkit that turns landed reference records into typed tables.

``functions`` holds ``Column -> Column`` expressions, ``sources`` readers for landed
files, ``operators`` ``DataFrame -> DataFrame`` steps, ``plans`` one declared table per
record family, ``streaming`` incremental landing and ``checks`` the registered queries.
"""
