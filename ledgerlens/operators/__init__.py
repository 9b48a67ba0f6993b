"""ledgerlens.operators."""
