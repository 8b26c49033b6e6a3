"""Training-data pipeline operators: tokenisation, near-duplicates, classifiers, search and mixing."""
