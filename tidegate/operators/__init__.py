"""Pure DataFrame operators: no state, no actions except where a value is the result."""
