"""Inboxlens: mailbox analytics as plain Spark DataFrames.

Every public function takes and returns DataFrames (or Columns) and stays lazy
unless its docstring says that it writes.  All timestamps are UTC instants; call
:func:`inboxlens.session.prepare` once per session.
"""
