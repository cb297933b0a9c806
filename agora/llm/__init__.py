"""Training-data operators: ten independent operators over documents and pages.

Nothing else in the library imports this package. Every operator takes a
DataFrame and the names of its id and text columns, reads only those, and
returns the columns its docstring lists; ``queries.py`` registers one query per
operator.
"""
