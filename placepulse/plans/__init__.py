"""Jobs: compositions of the operators, one function each."""
