"""DataFrame operators: lookup, preparation, models, validation, scoring, tables."""
