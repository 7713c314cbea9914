"""Readers: raw sales files, workbooks, weather documents, tables, synthetic rows."""
