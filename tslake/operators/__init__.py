"""Pure DataFrame-to-DataFrame operators."""
