"""Operators for preparing training text.  Nothing else in quillmine imports this subpackage."""
