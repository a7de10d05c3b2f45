"""Product feeds derived from the TPC-H-like tables, and the queries registered over them."""
