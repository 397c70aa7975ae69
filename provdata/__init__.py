"""provdata: a Spark-native engine for provider-registry data.

Sub-packages: ``sources`` (readers, writers, driver-table bindings),
``functions`` (column expressions and fixed values), ``operators``
(DataFrame -> DataFrame jobs), ``plans`` (registered queries with oracle
SQL), ``streaming`` (Structured Streaming twins).
"""
