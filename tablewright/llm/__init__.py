"""Operators for large text corpora: filters, deduplication, decontamination, tokenizing, chat rows."""
