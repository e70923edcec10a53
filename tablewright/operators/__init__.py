"""Table operators: normalize, catalog, relationships, views, questions."""
