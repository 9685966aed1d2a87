"""DataFrame -> DataFrame operators.  Each returns a lazy DataFrame; none collects."""
