"""Operators over voxel, chunk, cell and ontology tables."""
