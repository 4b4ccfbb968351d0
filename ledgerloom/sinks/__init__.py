"""Writers: named datasets with their column dictionary."""
