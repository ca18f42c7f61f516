"""Reading landed files and stored tables, and writing them."""
