"""Writers of search results and series."""
