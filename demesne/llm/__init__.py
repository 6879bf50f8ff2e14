"""Operators for corpora that train language models; nothing outside this package imports it."""
