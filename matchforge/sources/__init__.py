"""Reading landed files and writing processed tables, marts and relational copies."""
