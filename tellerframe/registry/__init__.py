"""Every operator as a runnable query over the test tables, with SQL to check it."""
