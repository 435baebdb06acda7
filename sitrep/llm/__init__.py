"""Corpus preparation for language-model training: ten operators and their registered queries."""
