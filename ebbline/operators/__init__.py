"""DataFrame operators, parameterised by tables and column names."""
