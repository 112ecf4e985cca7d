"""ANSI SQL over the same tables, stating what each query must return."""
