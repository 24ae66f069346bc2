"""Column functions; every one is a native Spark expression unless its docstring says otherwise."""
