"""Training-data operators (see the modules); nothing else in the library imports this package."""
