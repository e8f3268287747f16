"""Readers: workbooks, file listings, ERP tables, CSV masters, the lake itself."""
