"""Every operator as a named query over the test tables, with its SQL twin."""
