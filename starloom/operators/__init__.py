"""DataFrame -> DataFrame building blocks, parameterised by column names."""
