"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage.  ``queries`` registers
one thin query per operator; ``corpus_pipeline.py`` at the repository top
chains five of them.
"""
