"""Loads that pick up only the files that arrived since their last run."""
