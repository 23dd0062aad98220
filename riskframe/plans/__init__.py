"""Whole jobs: training, projection, segmentation, and the binding to the test tables."""
