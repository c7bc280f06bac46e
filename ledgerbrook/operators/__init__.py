"""DataFrame-in, DataFrame-out steps; none of them runs a Spark job by itself."""
