"""Jobs built from the operators: gold tables, the scout view and the reports."""
