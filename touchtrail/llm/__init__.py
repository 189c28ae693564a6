"""Operators for preparing text corpora: cleaning, de-duplication, scanning, packing."""
