"""Column functions: text cleaning, typed coercion, predicates, date layouts."""
