"""Column-parametrised building blocks, each a composition of built-in Spark operators."""
