"""Operators on texts for training language models. Nothing outside this subpackage imports it."""
