"""Driver queries: the library's operators run over the TPC-H-like tables."""
