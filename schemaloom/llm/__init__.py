"""Operators over large text and record collections. Nothing outside this subpackage imports it."""
