"""Training-data operators: one module per operator, all DataFrame -> DataFrame.

Nothing outside this subpackage imports it. ``queries`` registers one query per operator;
``corpus_pipeline.py`` at the repository top chains five of them.
"""
