"""Operators for preparing training data, each on whole tables of documents, vectors or pages."""
