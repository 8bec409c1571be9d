"""Operators for training text: leaks, repeats, tokens, quality, scores, joins, chats, secrets.

Nothing else in the library imports this package.  Documents are rows with a ``doc_id`` and a
``text``; other columns may be there under any name and are left alone unless an operator
says so.
"""
