"""Readers and writers of the formats that road networks come in."""
