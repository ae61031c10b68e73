"""Incremental jobs: each runs over what is new and stops, or keeps running."""
