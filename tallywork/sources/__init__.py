"""Reading and writing tables, and binding them to the shop model."""
