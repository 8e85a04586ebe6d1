"""Operators for preparing training corpora: filters, near copies, decontamination, extraction, mixing."""
