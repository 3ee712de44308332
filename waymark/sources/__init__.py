"""Readers that find out how a file is written, and writers that never change what they wrote."""
