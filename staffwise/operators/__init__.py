"""DataFrame -> DataFrame operators: Silver, Gold, marts, checks, profiling,
page data sets."""
