"""Domain operators; each is a function of (Tables, Day) returning a lazy DataFrame."""
