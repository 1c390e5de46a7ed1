"""Operators for preparing language-model training data at scale.

Ten operators, one module each.  Nothing outside this subpackage imports it; the thin registered
queries over the standard tables and their SQL are in :mod:`tideline.llm.queries`.
"""
