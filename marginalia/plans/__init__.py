"""Whole jobs: operators chained from input path to published output."""
