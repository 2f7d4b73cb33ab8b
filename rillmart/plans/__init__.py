"""The warehouse jobs as compositions of operators."""
