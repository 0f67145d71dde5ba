"""Jobs that act: write, verify, publish, load, build marts.

Operators stay lazy ``DataFrame -> DataFrame``; plans run them, write to a
staging area under the lake, verify by reading back, then publish by
moving whole partition folders.
"""
