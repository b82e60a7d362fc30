"""The operators on the benchmark tables, with equivalent SQL to check them."""
