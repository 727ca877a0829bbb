"""Spark jobs that keep large archives of gridded scans ordered, complete and correct."""
