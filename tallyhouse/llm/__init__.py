"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; ``queries`` has
the thin ``opN_<name>`` queries over the driver tables.  Nothing outside this
package imports it.
"""
