"""Training-data operators over text tables. Nothing outside this subpackage imports it.

Each operator module has a general interface; ``queries.py`` derives the fixed
result columns from it.  Executors must be able to import ``trailmark`` (ship it
with ``--py-files`` or install it on the workers).
"""
