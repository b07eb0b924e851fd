"""DataFrame operators: headers, cleaning, metrics, reports."""
