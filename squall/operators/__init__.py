"""DataFrame -> DataFrame transforms.  Each works unchanged on a batch
DataFrame and on a streaming one unless its docstring says otherwise."""
