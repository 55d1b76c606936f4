"""Corpus curation and question-answer analytics as Spark DataFrame operators."""
