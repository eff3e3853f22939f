"""Jobs that compose the operators: raw files in, result tables out."""
