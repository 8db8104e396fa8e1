"""Every operator as a query over the given tables, beside the SQL it must agree with."""
