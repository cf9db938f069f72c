"""DataFrame jobs over node tables, genome catalogues and clade lists."""
