"""Every operator bound to the given tables, each with its SQL equivalent."""
