"""Search over tables with Spark."""

from seekframe.plans import index_search  # noqa: F401  (registers the index strategy)
from seekframe.plans.search import Matched, Search, register_strategy, search, search_index
from seekframe.session import configure, shared_dir
from seekframe.sources.index import Catalog, Index, IndexWriteError
from seekframe.spec import SearchSpec

__all__ = [
    "Catalog",
    "Index",
    "IndexWriteError",
    "Matched",
    "Search",
    "SearchSpec",
    "configure",
    "register_strategy",
    "search",
    "search_index",
    "shared_dir",
]
