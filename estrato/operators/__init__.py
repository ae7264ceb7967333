"""DataFrame operators. Lazy, parameterised by keys and columns, nothing data-sized on the driver."""
