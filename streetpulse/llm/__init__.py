"""Training-data operators over the tables documents, pages, conversations,
benchmark and labels. Nothing else in the library imports this subpackage."""
