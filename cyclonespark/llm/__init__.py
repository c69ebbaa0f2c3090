"""Operators for large-scale training-data pipelines.

One module per operator; ``queries.py`` registers them.  Nothing outside this
package imports it, so it can be deleted without touching the rest of the library.
"""
