"""Operators for corpora of training texts. Nothing outside this folder imports them."""
