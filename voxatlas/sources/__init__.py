"""Readers and writers of images, points and tables."""
