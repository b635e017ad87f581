"""Training-data operators: token counts, classifiers, chat formatting, scans, search, joins and mixing.

Nothing outside this subpackage imports it.
"""
