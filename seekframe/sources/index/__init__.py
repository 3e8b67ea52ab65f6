"""Keyed document indexes."""

from seekframe.sources.index.store import Catalog, Index, IndexWriteError, merge_documents, rejects

__all__ = ["Catalog", "Index", "IndexWriteError", "merge_documents", "rejects"]
