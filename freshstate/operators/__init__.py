"""DataFrame kernels. Each takes and returns DataFrames; parameters such as
``now_ms``, ``ttl_ms`` or tick periods are plain arguments, never read from
the wall clock inside a kernel."""
