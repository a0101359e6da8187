"""Operators for building training corpora: deduplication, decontamination, language
identification, secret scans, token counts, chat rendering and source mixing."""
