"""Record matching on Spark: fixed-width submissions against employer master tables."""
