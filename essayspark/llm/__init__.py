"""Operators for preparing training text at scale: deduplication,
decontamination, quality and toxicity scoring, language-model scoring,
tokenisation and main-text extraction.  Nothing outside this subpackage
imports it."""
