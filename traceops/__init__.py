"""Cluster-trace analyses as Spark DataFrame operators, batch and streaming."""
