"""Set-oriented operators: keys and ids, normalisation, validation, mutation, arrays."""
