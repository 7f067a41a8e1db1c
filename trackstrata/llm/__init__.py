"""Operators for large text corpora. Each module holds one operator with an interface of its own;
``queries`` applies them to the test tables. Nothing else in the library imports this package."""
