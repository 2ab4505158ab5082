"""Volumetric image and cell-table analytics on Spark."""
