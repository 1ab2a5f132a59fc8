"""Named queries built from the operators, with their SQL where SQL can say the same."""
