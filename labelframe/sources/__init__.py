"""Reading and writing tables, column lists and fitted parameters."""
