"""Reading and writing tables, and the shared working folder."""
