"""Named questions and reports, composed from the operators."""
