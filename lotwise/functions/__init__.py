"""Column expressions and the HTML table function."""
