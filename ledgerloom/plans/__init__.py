"""Data products: the datasets and reports that users ask for."""
