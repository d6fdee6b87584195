"""Holdout routing on a `readStream` rating source."""
