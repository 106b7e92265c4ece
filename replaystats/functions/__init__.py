"""Column functions: scalar expressions, rating formulas and array builders."""
