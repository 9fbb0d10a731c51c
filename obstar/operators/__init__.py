"""DataFrame operators, parameterised by columns and keys."""
