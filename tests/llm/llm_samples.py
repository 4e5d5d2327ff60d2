"""Rows that every operator must handle, shared by the tests."""

import os

import pytest

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

#: Null, empty, blank, very long, repeated and odd texts, as (doc_id, text).
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "word " * 30_000), (5, "one two three four five six seven."),
       (6, "one two three four five six seven."), (7, "x" * 40_000), (8, "é😀 ü\n\n中文 <s> ▁▁ a  b"), (9, "short"),
       (9, "short"), (None, "a text without an id, but with words."), (10, "\n".join(f"line {i}." for i in range(3000)))]
