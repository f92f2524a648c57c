"""Training-data operators over tables of documents and pages.

Nothing outside this subpackage imports it.
"""
