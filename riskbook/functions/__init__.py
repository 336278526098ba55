"""Column expressions and the fixed vocabularies of the loan domain."""
