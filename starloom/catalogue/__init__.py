"""Every operator bound to TPC-H shaped tables, with an equivalent SQL text each."""
